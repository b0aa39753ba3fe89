from lakewarden.plans import q_access, q_governance, q_medallion  # noqa: F401
from lakewarden.plans.registry import QUERIES, SQL  # noqa: F401
