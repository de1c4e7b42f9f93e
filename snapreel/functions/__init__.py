"""Column-level helpers: typed VARIANT reads, strict dates, ordered string aggregation."""

from snapreel.functions.variant import (  # noqa: F401
    BOOLEAN, FLOAT, NUMBER, STRING, flatten, vget, vnum, vstr,
)
from snapreel.functions.scalars import (  # noqa: F401
    iso_timestamp_ntz, strict_date, try_iso_date, utc_now_iso, utc_today_iso,
)
from snapreel.functions.aggregates import first_by_name, ordered_listagg  # noqa: F401
