"""Tags on objects and columns, domains, certification and catalogue search."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakewarden.operators.lineage import closure

KEYS = ["catalog", "schema", "object", "column_name"]
OBJECT = ["catalog", "schema", "object"]


def current_tags(log: DataFrame, order: list[str], keys: list[str] = KEYS) -> DataFrame:
    """Net tags of a change log: the last change per (column, tag) wins, unset ones are gone.

    Spark keeps one row per column and tag in each task before the shuffle, so an object with very many
    changes is already reduced there. ``order`` must be total up to equal changes.
    """
    newest = Window.partitionBy(*keys, "tag_name").orderBy(*[F.col(c).desc() for c in (*order, "action", "tag_value")])
    rows = log.select(*keys, "tag_name", *order, "action", "tag_value").withColumn("_rank", F.row_number().over(newest))
    return rows.filter((F.col("_rank") <= 1) & (F.col("action") == "SET")).select(*keys, "tag_name", "tag_value")


def apply_tags(tags: DataFrame, changes: DataFrame, order: list[str], keys: list[str] = KEYS) -> DataFrame:
    """Current tags after a batch of SET / UNSET changes; every change is newer than the tags."""
    kinds = dict(changes.dtypes)
    old = tags.withColumn("action", F.lit("SET")).withColumns({c: F.lit(None).cast(kinds[c]) for c in order})
    return current_tags(old.unionByName(changes.select(*old.columns)), order, keys)


def find_tagged(tags: DataFrame, name: str, value: str | None = None) -> DataFrame:
    found = tags.filter(F.col("tag_name") == name)
    if value is not None:
        found = found.filter(F.col("tag_value") == value)
    return found.orderBy(*KEYS, "tag_value")


def tag_violations(tags: DataFrame, vocab: DataFrame) -> DataFrame:
    """Governed tags whose value is not in the vocabulary, with the number of columns affected."""
    used = tags.groupBy("tag_name", "tag_value").agg(F.count(F.lit(1)).alias("n_columns"))
    governed = used.join(vocab.select("tag_name").distinct(), "tag_name", "left_semi")
    allowed = vocab.select("tag_name", F.col("allowed_value").alias("tag_value"))
    return governed.join(allowed, ["tag_name", "tag_value"], "left_anti")


def tag_key(value: Column) -> Column:
    """Spelling-free form: lower case, letters and digits only."""
    return F.regexp_replace(F.lower(value), "[^a-z0-9]", "")


def tag_variants(tags: DataFrame) -> DataFrame:
    """Values of a tag that differ only in spelling. Counted per value first, then per spelling-free form."""
    used = tags.groupBy("tag_name", "tag_value").agg(F.count(F.lit(1)).alias("n"))
    return (
        used.groupBy("tag_name", tag_key(F.col("tag_value")).alias("normal_form"))
        .agg(F.count(F.lit(1)).alias("n_spellings"), F.sum("n").alias("n_columns"),
             F.min("tag_value").alias("first_spelling"), F.max("tag_value").alias("last_spelling"))
        .filter(F.col("n_spellings") > 1)
    )


def _shortened(word: Column, most: int) -> Column:
    """The word and all that is left of it without up to ``most`` of its letters."""
    level = out = F.array(word)
    for _ in range(most):
        level = F.array_distinct(F.flatten(F.transform(level, lambda w: F.when(F.length(w) > 0, F.transform(
            F.sequence(F.lit(1), F.length(w)), lambda i: F.concat(F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, F.length(w)))))
            .otherwise(F.array().cast("array<string>")))))
        out = F.array_union(out, level)
    return out


def near_misses(tags: DataFrame, vocab: DataFrame, most: int = 2) -> DataFrame:
    """Tag values outside the vocabulary with the allowed values that at most ``most`` edits make of them.

    Two words that near share a word that either becomes by leaving out up to ``most`` letters, so values and allowed
    ones meet on such words, and only what meets is compared. Values longer than any allowed one and ``most`` more
    cannot be near and are not shortened.
    """
    allowed = vocab.select("tag_name", "allowed_value").dropna().distinct()
    unknown = tags.groupBy("tag_name", "tag_value").agg(F.count(F.lit(1)).alias("n_columns")).join(
        allowed.withColumnRenamed("allowed_value", "tag_value"), ["tag_name", "tag_value"], "left_anti")
    longest = allowed.groupBy("tag_name").agg(F.max(F.length("allowed_value")).alias("_longest"))
    left = unknown.join(longest, "tag_name").filter(F.length("tag_value") <= F.col("_longest") + most).select(
        "tag_name", "tag_value", "n_columns", F.explode(_shortened(F.col("tag_value"), most)).alias("_form"))
    right = allowed.select("tag_name", "allowed_value", F.explode(_shortened(F.col("allowed_value"), most)).alias("_form"))
    met = left.join(right, ["tag_name", "_form"]).select("tag_name", "tag_value", "n_columns", "allowed_value").distinct()
    return met.withColumn("edits", F.levenshtein("tag_value", "allowed_value")).filter(F.col("edits") <= most).select(
        "tag_name", "tag_value", "n_columns", F.col("allowed_value").alias("suggestion"), "edits")


def tag_coverage(columns: DataFrame, tags: DataFrame, by: list[str]) -> DataFrame:
    """Share of columns that carry any tag."""
    tagged = tags.select(*KEYS).distinct().withColumn("tagged", F.lit(1))
    return (
        columns.join(tagged, KEYS, "left").groupBy(*by)
        .agg(F.count(F.lit(1)).alias("n_columns"), F.count("tagged").alias("n_tagged"))
        .withColumn("coverage", F.round(F.col("n_tagged").cast("double") / F.col("n_columns"), 6))
    )


def tag_changes(classified: DataFrame, tag_name: str = "pii", value: str = "true", label: str = "PII",
                changed_on: date | None = None) -> DataFrame:
    """SET changes for the columns that a classification gave ``label``, in the form of the tag log."""
    return classified.filter(F.col("classification") == label).select(
        *KEYS, F.lit(tag_name).alias("tag_name"), F.lit(value).alias("tag_value"), F.lit("SET").alias("action"),
        F.lit(changed_on).cast("date").alias("changed_on"), F.lit(0).cast("bigint").alias("seq"))


def propagate_tags(tagged: DataFrame, column_edges: DataFrame, max_depth: int | None = None) -> DataFrame:
    """Columns that inherit the tag along column lineage.

    ``tagged`` has one ``node`` per tagged column; edges are (src, dst). Returns (node, depth),
    depth 0 being the tagged columns themselves.
    """
    return closure(column_edges, tagged.select("node"), max_depth).select("node", "depth")


def certification(assets: DataFrame, tags: DataFrame, default: str = "uncertified") -> DataFrame:
    """State per asset: deprecated on any column wins over certified, no tag means ``default``."""
    marks = tags.filter(F.col("tag_name") == "certification").groupBy(*OBJECT).agg(
        F.max(F.when(F.col("tag_value") == "deprecated", 2).when(F.col("tag_value") == "certified", 1).otherwise(0))
        .alias("mark"))
    state = F.when(F.col("mark") == 2, "deprecated").when(F.col("mark") == 1, "certified").otherwise(default)
    return assets.join(marks, OBJECT, "left").withColumn("certification", state).drop("mark")


def _claims(domain_assets: DataFrame) -> DataFrame:
    return domain_assets.select("domain", *OBJECT).distinct()


def domain_contents(domain_assets: DataFrame, assets: DataFrame, roles: DataFrame | None = None) -> DataFrame:
    """Known assets per domain and schema, and how many of them are claimed by more than one domain.

    ``domain_assets`` and ``assets`` name an asset by catalog, schema and object. ``roles`` has (domain,
    technical_owner, business_owner), one row per domain, and adds both.
    """
    claims = _claims(domain_assets).join(assets.select(*OBJECT).distinct(), OBJECT, "left_semi")
    n_domains = claims.groupBy(*OBJECT).agg(F.count(F.lit(1)).alias("n_domains"))
    found = claims.join(n_domains, OBJECT).groupBy("domain", "catalog", "schema").agg(
        F.count(F.lit(1)).alias("n_assets"), F.count_if(F.col("n_domains") > 1).alias("n_conflicts"))
    return found if roles is None else found.join(
        roles.select("domain", "technical_owner", "business_owner"), "domain", "left")


def domain_conflicts(domain_assets: DataFrame) -> DataFrame:
    """Assets that several domains claim, with the number of domains and the first and last of them."""
    return _claims(domain_assets).groupBy(*OBJECT).agg(
        F.count(F.lit(1)).alias("n_domains"), F.min("domain").alias("first_domain"),
        F.max("domain").alias("last_domain")).filter(F.col("n_domains") > 1)


def with_facets(assets: DataFrame, tags: DataFrame | None = None, domain_assets: DataFrame | None = None,
                owners: DataFrame | None = None) -> DataFrame:
    """Assets with the sets of their ``tags`` (name=value), ``domains`` and ``owners``, empty where there are none.

    Each set is as large as what one asset carries.
    """
    none = F.array().cast("array<string>")

    def add(df: DataFrame, pairs: DataFrame, name: str) -> DataFrame:
        sets = pairs.distinct().groupBy(*OBJECT).agg(F.array_sort(F.collect_list("value")).alias(name))
        return df.join(sets, OBJECT, "left").withColumn(name, F.coalesce(name, none))

    if tags is not None:
        assets = add(assets, tags.select(*OBJECT, F.concat_ws("=", "tag_name", "tag_value").alias("value")), "tags")
    if domain_assets is not None:
        assets = add(assets, domain_assets.select(*OBJECT, F.col("domain").alias("value")), "domains")
    if owners is not None:
        assets = add(assets, owners.filter(F.col("object").isNotNull()).select(*OBJECT, F.col("owner").alias("value")), "owners")
    return assets


def asset_search(assets: DataFrame, keyword: str, facets: dict[str, str] | None = None) -> DataFrame:
    """Keyword in name or comment, any case, narrowed by facet values: equal, or held by a set."""
    text = F.lower(F.concat_ws(" ", "name", "comment"))
    found = assets.filter(F.contains(text, F.lit(keyword.lower())))
    kinds = dict(assets.dtypes)
    for column, value in (facets or {}).items():
        held = F.array_contains(column, value) if kinds[column].startswith("array") else F.col(column) == value
        found = found.filter(held)
    return found


def facet_counts(assets: DataFrame, facets: list[str]) -> DataFrame:
    """Number of assets per facet value, all facets in one pass; an asset counts once for each value of a set."""
    kinds = dict(assets.dtypes)

    def pairs_of(f: str) -> Column:
        values = F.col(f) if kinds[f].startswith("array") else F.array(F.col(f).cast("string"))
        return F.transform(values, lambda v: F.struct(F.lit(f).alias("facet"), v.alias("value")))

    pairs = F.concat(*map(pairs_of, facets))
    return assets.select(F.inline(pairs)).groupBy("facet", "value").agg(F.count(F.lit(1)).alias("n_assets"))
