"""All named queries and their SQL counterparts."""

from entityloom.catalog import cleaning, encoding, joining, modelling, pipelines, profiling, projections, rollups, scalars
from entityloom.catalog.base import QUERIES, SQL

__all__ = [
    "QUERIES",
    "SQL",
    "cleaning",
    "encoding",
    "joining",
    "modelling",
    "pipelines",
    "profiling",
    "projections",
    "rollups",
    "scalars",
]
