"""Set-based operators: change detection, SCD2, lookups, rate merge, keys, facts."""

from dimweave.operators.changes import changed_rows  # noqa: F401
from dimweave.operators.facts import key_in_force, teller_to_fact, teller_to_fact_at  # noqa: F401
from dimweave.operators.keys import assign_surrogate_keys  # noqa: F401
from dimweave.operators.lookups import (  # noqa: F401
    Lookup,
    current_versions,
    dedupe_lookup,
    flag_known,
    priority_lookup,
)
from dimweave.operators.ordered import assign_chunks, drop_scan_columns, keyed_scan  # noqa: F401
from dimweave.operators.rates import (  # noqa: F401
    normalise_rate_events,
    rate_events,
    rates_before,
    rates_final,
)
from dimweave.operators.scd2 import scd2_versions  # noqa: F401
