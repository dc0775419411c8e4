"""All registered queries; importing the modules fills the registry."""

from wearline.catalog import (  # noqa: F401
    aggregation,
    alerting,
    data_quality,
    fitting,
    projection,
    scoring,
    series,
    storage,
    training,
)
from wearline.catalog.registry import ORACLES, QUERIES  # noqa: F401
