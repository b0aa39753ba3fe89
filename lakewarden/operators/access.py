"""Privileges: net grants, effective access, gaps, audit and request reports.

Grants have (securable_type, catalog, schema, object, grantee, privilege); memberships have
(principal, grp). Reading an object needs USE CATALOG, USE SCHEMA and SELECT (running a function:
EXECUTE). USE SCHEMA and SELECT may be granted higher up and cascade; a group's grants hold for its
members; the owner of an object, of its schema or of its catalog holds SELECT on it, and the owner of a schema
or catalog also the use of it. Everything below a schema is an object, be it a table, a function or a model.
Grants are those in force: a log of grants and revokes goes through ``net_grants`` first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewarden.operators.lineage import closure
from lakewarden.session import stage, stage_all

SECURABLE = ["securable_type", "catalog", "schema", "object"]
SCHEMA = ["catalog", "schema"]
OBJECT = ["catalog", "schema", "object"]


def _in_force(grants: DataFrame) -> DataFrame:
    if "action" in grants.columns:
        raise ValueError("this is a log of grants and revokes; pass net_grants(log)")
    return grants


def access_audit(grants: DataFrame, schemas: list[str]) -> DataFrame:
    return _in_force(grants).filter(F.col("schema").isin(*schemas)).orderBy("catalog", "schema", "object", "grantee", "privilege")


def net_grants(log: DataFrame) -> DataFrame:
    """Grants in force: the last action per (securable, grantee, privilege), revoked ones gone.

    Day, sequence number and action are one number, so the newest is kept by a hash aggregate; of a
    grant and a revoke with equal day and number the revoke counts.
    """
    keys = [*SECURABLE, "grantee", "privilege"]
    day = F.col("changed_on")
    if dict(log.dtypes)["changed_on"] == "date":
        day = F.datediff(day, F.lit("1970-01-01").cast("date"))
    place = day.cast("decimal(10,0)") * F.lit(str(10**19)).cast("decimal(20,0)") + F.col("seq").cast("decimal(19,0)")
    newest = F.max((place * 2 + F.when(F.col("action") == "GRANT", 0).otherwise(1)).cast("decimal(38,0)")).alias("last")
    return log.groupBy(*keys).agg(newest).filter(F.col("last") % 2 == 0).select(*keys)


def expand_members(members: DataFrame, group_edges: DataFrame) -> DataFrame:
    """(principal, grp) through nested groups. The closure runs over the groups alone."""
    groups = members.select("grp").distinct()
    reach = closure(group_edges, groups.select(F.col("grp").alias("origin"), F.col("grp").alias("node")))
    return members.join(
        reach.select(F.col("origin").alias("grp"), "node"), "grp"
    ).select("principal", F.col("node").alias("grp")).distinct()


def _fingerprint(col: str) -> list[Column]:
    """Identifies a set of distinct values by count and the sums of both halves of their MD5, without collecting it."""
    def half(start: int) -> Column:
        digits = F.substring(F.md5(F.col(col).cast("string")), start, 15)
        return F.sum(F.conv(digits, 16, 10).cast("decimal(20,0)")).cast("decimal(38,0)")

    return [F.count(F.lit(1)).alias("f0"), half(1).alias("f1"), half(17).alias("f2")]


def _flags(rights: list[str], suffix: str) -> list[Column]:
    """One TRUE-or-NULL column per right."""
    return [F.max(F.when(F.col("right") == r, F.lit(True))).alias(f"{r}_{suffix}") for r in rights]


def _has(right: str, *suffixes: str) -> Column:
    return F.coalesce(*[F.col(f"{right}_{s}") for s in suffixes], F.lit(False))


def _owned_places(owners: DataFrame, wanted: str) -> DataFrame:
    """What owners of schemas and catalogs hold there, as grants; such a row has no object, a catalog no schema."""
    places = owners.filter(F.col("object").isNull())
    kind = F.when(F.col("schema").isNull(), "CATALOG").otherwise("SCHEMA")
    rights = F.when(F.col("schema").isNull(), F.array(*map(F.lit, ("USE CATALOG", "USE SCHEMA", wanted)))).otherwise(
        F.array(*map(F.lit, ("USE SCHEMA", wanted))))
    return places.select(kind.alias("securable_type"), *OBJECT, F.col("owner").alias("grantee"),
                         F.explode(rights).alias("privilege"))


# Rights are flagged per holder: by the class on the catalog and on the schema, by the principal
# itself on the catalog and on the schema.
BY_CLASS = ["class_catalog", "class_schema"]
OWN = ["own_catalog", "own_schema"]
NO_CLASS = "none"


class _Rights:
    """Who holds which privilege where, kept apart for groups and for single principals.

    Principals in the same set of groups form one class, and so do objects of a schema that are
    granted to the same set of groups. What groups give is held per class, never per member, and
    a grant on a catalog stays one row, however many schemas it reaches. The rights are "catalog"
    (USE CATALOG), "schema" (USE SCHEMA) and "whole" (the wanted privilege on a schema or catalog).
    """

    def __init__(self, grants: DataFrame, memberships: DataFrame, objects: DataFrame, owners: DataFrame | None,
                 wanted: str):
        held_now = _in_force(grants).select(*SECURABLE, "grantee", "privilege")
        if owners is not None:
            held_now = held_now.unionByName(_owned_places(owners, wanted))
            owners = owners.filter(F.col("object").isNotNull())
        base = stage_all({
            "members": memberships.select("principal", "grp").distinct(),
            "grants": held_now.distinct(),
            "sizes": objects.groupBy(*SCHEMA).agg(F.count(F.lit(1)).alias("n_objects")),
        })
        memberships, grants, self.sizes = base["members"], base["grants"], base["sizes"]
        self.groups = memberships.select(F.col("grp").alias("grantee")).distinct()
        finger = ["f0", "f1", "f2"]

        marks = memberships.groupBy("principal").agg(*_fingerprint("grp"))
        heads = marks.groupBy(*finger).agg(F.min("principal").alias("head"), F.count(F.lit(1)).alias("n_principals"))
        above = F.col("securable_type").isin("CATALOG", "SCHEMA")
        named = grants.filter((F.col("privilege") == wanted) & ~above).select("grantee", *OBJECT)
        if owners is not None:
            named = named.unionByName(owners.select(F.col("owner").alias("grantee"), *OBJECT))
        base = stage_all({
            "class_of": marks.join(heads, finger).select(
                "principal", "head", F.concat(F.lit("like "), "head").alias("cls"), "n_principals"),
            "named": named.distinct(),
        })
        self.class_of, named = base["class_of"], base["named"]
        first = self.class_of.filter(F.col("principal") == F.col("head"))
        self.classes = first.select("cls", "n_principals")
        self.class_groups = memberships.join(first, "principal").select("cls", F.col("grp").alias("grantee"))

        privilege = F.col("privilege")
        right = (
            F.when(privilege == "USE CATALOG", "catalog").when(privilege == "USE SCHEMA", "schema")
            .when((privilege == wanted) & above, "whole"))
        held = grants.withColumn("right", right).filter(F.col("right").isNotNull())
        on_catalog = held.filter(F.col("securable_type") == "CATALOG").select("grantee", "catalog", "right")
        on_schema = held.filter(F.col("securable_type") == "SCHEMA").select("grantee", *SCHEMA, "right")

        group_objects = named.join(self.groups, "grantee", "left_semi")
        self.given = group_objects
        object_marks = group_objects.groupBy(*OBJECT).agg(*_fingerprint("grantee"))
        object_heads = object_marks.groupBy(*SCHEMA, *finger).agg(
            F.min("object").alias("object_cls"), F.count(F.lit(1)).alias("n"))
        staged = stage_all({
            "class_catalogs": self._by_class(on_catalog, ["catalog"], ["catalog", "schema", "whole"]),
            "class_schemas": self._by_class(on_schema, SCHEMA, ["schema", "whole"]),
            "own_catalogs": self._by_principal(on_catalog, ["catalog"], ["catalog", "schema", "whole"]),
            "own_schemas": self._by_principal(on_schema, SCHEMA, ["schema", "whole"]),
            # object, the first object of its class, size of the class
            "object_class_of": object_marks.join(object_heads, [*SCHEMA, *finger]).select(*OBJECT, "object_cls", "n"),
        })
        self.class_catalogs, self.class_schemas = staged["class_catalogs"], staged["class_schemas"]
        self.own_catalogs, self.own_schemas = staged["own_catalogs"], staged["own_schemas"]
        self.object_class_of = staged["object_class_of"]
        self.own_objects = self._own(named)
        head = self.object_class_of.filter(F.col("object") == F.col("object_cls")).drop("object")
        # (grantee, class of objects): one row per group and object class, whoever is in the group
        self.group_objects = group_objects.withColumnRenamed("object", "object_cls").join(head, [*SCHEMA, "object_cls"])

    def class_counts(self) -> DataFrame:
        """(cls, catalog, schema, n): objects that the groups of a class may select in a schema.

        Objects are numbered in the order of their schemas, each group's objects of a schema are bitmaps of these
        numbers, and a class unites the bitmaps of its groups, per task first. Rows grow with memberships and
        schemas, not with objects, also where every principal has groups of its own.
        """
        numbered = stage(self.given.select(*OBJECT).distinct().repartitionByRange(*OBJECT).sortWithinPartitions(*OBJECT).select(
            *OBJECT, (F.monotonically_increasing_id() + 1).alias("number")), "numbers")
        bits = stage(self.given.join(numbered, OBJECT).groupBy(
            "grantee", *SCHEMA, F.bitmap_bucket_number("number").alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")), "bitmaps")
        united = bits.join(self.class_groups, "grantee").groupBy("cls", *SCHEMA, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
        return united.groupBy("cls", *SCHEMA).agg(F.sum(F.bitmap_count("bits")).alias("n"))

    def _own(self, df: DataFrame) -> DataFrame:
        """Grants to principals themselves."""
        return df.join(self.groups, "grantee", "left_anti").withColumnRenamed("grantee", "principal")

    def _by_class(self, df: DataFrame, place: list[str], rights: list[str]) -> DataFrame:
        return df.join(self.class_groups, "grantee").groupBy("cls", *place).agg(
            *_flags(rights, "class_catalog" if place == ["catalog"] else "class_schema"))

    def _by_principal(self, df: DataFrame, place: list[str], rights: list[str]) -> DataFrame:
        return self._own(df).groupBy("principal", *place).agg(
            *_flags(rights, "own_catalog" if place == ["catalog"] else "own_schema"))

    def with_class(self, df: DataFrame) -> DataFrame:
        joined = df.join(self.class_of.select("principal", "cls"), "principal", "left")
        return joined.fillna(NO_CLASS, subset=["cls"])

    def with_class_rights(self, df: DataFrame) -> DataFrame:
        return df.join(self.class_catalogs, ["cls", "catalog"], "left").join(
            self.class_schemas, ["cls", *SCHEMA], "left")

    def with_class_objects(self, df: DataFrame) -> DataFrame:
        """Adds ``object_cls_held``: SELECT on the object through groups.

        Only the pairs of classes that occur in ``df`` are looked up, each through the groups of its class,
        so pairs that nobody asks for are never made.
        """
        df = df.join(self.object_class_of.select(*OBJECT, "object_cls"), OBJECT, "left")
        pair = ["cls", *SCHEMA, "object_cls"]
        asked = df.filter(F.col("object_cls").isNotNull()).select(*pair).distinct()
        given = self.group_objects.select("grantee", *SCHEMA, "object_cls")
        held = asked.join(self.class_groups, "cls").join(given, ["grantee", *SCHEMA, "object_cls"], "left_semi").select(
            *pair).distinct().withColumn("object_cls_held", F.lit(True))
        return df.join(held, pair, "left")

    def with_rights(self, df: DataFrame) -> DataFrame:
        """Adds the class of the principal and every right on the place of the row."""
        own = df.join(self.own_catalogs, ["principal", "catalog"], "left").join(
            self.own_schemas, ["principal", *SCHEMA], "left")
        return self.with_class_rights(self.with_class(own))


def _usable(*holders: str) -> Column:
    on_catalog = [h for h in holders if h.endswith("catalog")]
    return _has("catalog", *on_catalog) & _has("schema", *holders)


def _added(*own: str) -> Column:
    """Objects of a place that a principal reads beyond what its class was counted with.

    ``n`` is what the class may select there, ``own`` the principal's rights to take into account.
    """
    n = F.coalesce("n", F.lit(0))
    sees = F.when(_has("whole", *own), F.col("n_objects")).otherwise(n)
    return F.when(_usable(*BY_CLASS, *own), sees).otherwise(0) - F.when(_usable(*BY_CLASS), n).otherwise(0)


def effective_access(
    grants: DataFrame, memberships: DataFrame, objects: DataFrame, owners: DataFrame | None = None,
    privilege: str = "SELECT",
) -> DataFrame:
    """Number of (principal, object) pairs that can be read, per catalog.

    The pairs themselves are never listed: what groups give is counted between classes, and the
    grants of single principals are counted as additions to what their class has.
    """
    r = _Rights(grants, memberships, objects, owners, privilege)
    # n: objects a class may select in a schema.
    whole = (
        r.class_schemas.filter("whole_class_schema").select("cls", *SCHEMA).join(r.sizes, SCHEMA)
        .unionByName(r.class_catalogs.filter("whole_class_catalog").select("cls", "catalog").join(r.sizes, "catalog"))
        .select("cls", *SCHEMA, F.col("n_objects").alias("n"))
    )
    selected = stage(
        whole.unionByName(r.class_counts())
        .groupBy("cls", *SCHEMA).agg(F.max("n").alias("n")),
        "selected",
    )
    by_class = (
        r.with_class_rights(selected).filter(_usable(*BY_CLASS)).join(r.classes, "cls")
        .select("catalog", (F.col("n") * F.col("n_principals")).alias("pairs"))
    )
    # Principals of one class with the same rights of their own on a catalog add the same there.
    alike = [f"{right}_own_catalog" for right in ("catalog", "schema", "whole")]
    own_catalogs = r.with_class(r.own_catalogs).groupBy("cls", "catalog", *alike).agg(
        F.count(F.lit(1)).alias("n_principals"))
    by_catalog = (
        r.with_class_rights(own_catalogs.join(r.sizes, "catalog")).join(selected, ["cls", *SCHEMA], "left")
        .select("catalog", (_added("own_catalog") * F.col("n_principals")).alias("pairs"))
    )
    # Where a principal has rights on a schema itself, the difference these make.
    own_schemas = r.own_schemas.join(r.own_catalogs, ["principal", "catalog"], "left")
    by_schema = (
        r.with_class_rights(r.with_class(own_schemas)).join(selected, ["cls", *SCHEMA], "left").join(r.sizes, SCHEMA)
        .select("catalog", (_added(*OWN) - _added("own_catalog")).alias("pairs"))
    )
    # Single objects that none of the above covers.
    single = r.with_rights(r.own_objects).filter(_usable(*BY_CLASS, *OWN) & ~_has("whole", *BY_CLASS, *OWN))
    by_object = r.with_class_objects(single).filter(F.col("object_cls_held").isNull()).select(
        "catalog", F.lit(1).cast("bigint").alias("pairs"))

    parts = by_class.unionByName(by_catalog).unionByName(by_schema).unionByName(by_object)
    return parts.groupBy("catalog").agg(F.sum("pairs").alias("readable_pairs")).filter(F.col("readable_pairs") > 0)


def access_gaps(
    required: DataFrame, grants: DataFrame, memberships: DataFrame, objects: DataFrame,
    owners: DataFrame | None = None, privilege: str = "SELECT",
) -> DataFrame:
    """Of the required (principal, object) pairs, those that cannot be read, with what is missing.

    Each pair is looked up once per kind of right, through its class, so groups do not multiply it. Pairs that the
    groups of the class open as a whole, by catalog or schema, have no gap; they are dropped after one shuffle, and only
    the others are made distinct and looked up among the rights of single principals and on single objects.
    """
    r = _Rights(grants, memberships, objects, owners, privilege)
    by_class = r.with_class_rights(r.with_class(required.select("principal", *OBJECT)))
    asked = stage(by_class.filter(~(_usable(*BY_CLASS) & _has("whole", *BY_CLASS))).select(
        "principal", *OBJECT).distinct(), "asked")
    own_objects = r.own_objects.select("principal", *OBJECT, F.lit(True).alias("object_own"))
    looked_up = r.with_class_objects(r.with_rights(asked)).join(own_objects, ["principal", *OBJECT], "left")
    holders = [*BY_CLASS, *OWN]
    may_select = _has("whole", *holders) | F.coalesce("object_cls_held", "object_own", F.lit(False))
    return looked_up.select(
        "principal", *OBJECT,
        F.concat_ws(
            ",",
            F.when(~_has("catalog", "class_catalog", "own_catalog"), "USE CATALOG"),
            F.when(~_has("schema", *holders), "USE SCHEMA"),
            F.when(~may_select, privilege),
        ).alias("missing"),
    ).filter(F.col("missing") != "")


def audit_rollup(events: DataFrame) -> DataFrame:
    """Accesses per principal, object and day, with first and last time."""
    return events.groupBy("principal", "object", F.col("at").cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("n_accesses"), F.min("at").alias("first_at"), F.max("at").alias("last_at"))


def request_queue(requests: DataFrame) -> DataFrame:
    """Per owner and status: number of requests and the mean days until a decision."""
    days = F.datediff("decided_on", "asked_on")
    return requests.groupBy("owner", "status").agg(
        F.count(F.lit(1)).alias("n_requests"),
        F.round(F.sum(days).cast("double") / F.count(days), 6).alias("mean_days"),
    )
