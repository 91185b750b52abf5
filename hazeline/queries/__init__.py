"""One registered query per operator, on the stand-in tables, with its SQL counterpart."""

from hazeline.queries import (  # noqa: F401
    aggregates, columns, composition, filters, flows, joins, models, quality, ranking,
    reshape, scalars, sets, sheets, sources,
)
from hazeline.queries.base import ORACLE, REGISTRY  # noqa: F401
