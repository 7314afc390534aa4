"""Operations data onboarding and analytics on Spark."""

from .operators import *  # noqa: F403
from .operators import __all__ as _operators
from .plans.entities import (
    CARRIER,
    FACILITY,
    FREIGHT,
    SHIPMENT,
    EntitySpec,
    FieldSpec,
    fields_table,
)
from .plans.extract_classes import cells_of, materialize_cells, read_cells
from .plans.pipeline import (
    PipelineResult,
    dataset_summary,
    map_all,
    materialize_many,
    profile_all,
    read_modelled,
    run_pipeline,
)
from .sources import *  # noqa: F403
from .sources import __all__ as _sources

__all__ = [
    *_operators,
    *_sources,
    "CARRIER",
    "FACILITY",
    "FREIGHT",
    "SHIPMENT",
    "EntitySpec",
    "FieldSpec",
    "PipelineResult",
    "cells_of",
    "dataset_summary",
    "fields_table",
    "map_all",
    "materialize_cells",
    "materialize_many",
    "profile_all",
    "read_cells",
    "read_modelled",
    "run_pipeline",
]
