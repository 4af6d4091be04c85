from tidewatch.functions.scalar import (  # noqa: F401
    anomaly_type,
    clean_id,
    directional_flag,
    entity_of_slice,
    epoch_us,
    from_epoch_us,
    log1p_clamped,
    parse_epoch_ms,
    series_id,
    to_numeric,
    zero_to_null,
)
from tidewatch.functions.catalog import FeatureCatalog, DEFAULT_CATALOG  # noqa: F401
