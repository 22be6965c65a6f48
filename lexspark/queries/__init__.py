"""All registered queries over the driver's tables, with their SQL where SQL can express them."""

from lexspark.queries import composite, markup, nested, relational, text  # noqa: F401
from lexspark.queries.registry import oracle_sql, queries  # noqa: F401
