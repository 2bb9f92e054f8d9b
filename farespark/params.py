"""Run-time parameters of the pipeline (one frozen object passed to builders)."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Params:
    # Fixed values that must equal the reference for identical results:
    #   ODS currency filter 'RUB'; DWH horizon 45 days; DM horizon 120 days;
    #   minimum samples for a segment to rank first: 3;
    #   default origins 'SVO,DME,VKO' and destinations 'LED,IST,DXB';
    #   loader defaults provider 'aviasales', ticket_class 'economy',
    #   currency 'RUB'.
    currency: str = "RUB"
    horizon_days: int = 45
    mart_horizon_days: int = 120
    min_segment_samples: int = 3
    default_origins: str = "SVO,DME,VKO"
    default_destinations: str = "LED,IST,DXB"
    default_provider: str = "aviasales"
    default_ticket_class: str = "economy"
    default_currency: str = "RUB"
    # Loader: what to do with a quote whose price is null ("quarantine" keeps
    # it out of STG, "zero" loads it with price 0 as a missing key would be).
    null_price: str = "quarantine"
    # DWH percentiles: exact percentile_disc (holds the distinct prices of a
    # group) or approx_percentile for very large groups.
    exact_percentiles: bool = True
    approx_accuracy: int = 10000
    # Exact percentiles through (group, price) counts and a sorted running
    # sum instead of one in-memory value map per group: one more shuffle,
    # but a group holding a huge share of the rows spills instead of
    # holding all its distinct prices in memory.
    skew_safe_percentiles: bool = False
    # Mart maintenance: fold each batch's new ODS rows into additive segment
    # state (True) instead of re-scanning all of ODS per batch (False, the
    # reference's full rebuild). Both write the whole mart table.
    incremental_mart: bool = True
    # DWH windows: carry the last daily rows of each route and departure from run
    # to run, so that a re-opened day reads its own quotes only (True), or read
    # the quotes of the whole horizon before it again (False).
    carried_windows: bool = True
    # STG, ODS and DWH as versioned tables (operators.versions): one write of a
    # touched partition, changes seen whole or not at all. Off, they are plain
    # partitioned folders, which a catalog table can be declared over. A table
    # that has versions keeps them; a plain one is taken over when this is set.
    versioned_tables: bool = False
    # A column whose model has become wider (int to long, more digits) widens
    # in a versioned table; otherwise the stored type stays and a value that
    # does not fit fails the run.
    widen_types: bool = False
    # Versions that a run leaves of such a table.
    keep_versions: int = 2
    # Independent models (DWH, DM) of one run are submitted concurrently.
    model_threads: int = 2
    # Anomaly checks (our own control chart; the reference gives no numbers):
    # z-score of a daily metric against the previous `anomaly_window` days,
    # needing `anomaly_min_history` of them, flagged when |z| > threshold.
    anomaly_window: int = 14
    anomaly_min_history: int = 7
    anomaly_z: float = 3.0

    def with_(self, **changes) -> "Params":
        return replace(self, **changes)


DEFAULT = Params()
