"""All registered queries: name -> (builder, oracle SQL or None)."""

from __future__ import annotations

from farespark.plans import registry_calendar, registry_dq, registry_io, registry_models, registry_stream

REGISTRY = {}
for _mod in (registry_models, registry_io, registry_dq, registry_stream, registry_calendar):
    for _name, _val in _mod.Q.items():
        if _name in REGISTRY:
            raise ValueError(f"duplicate query {_name}")
        REGISTRY[_name] = _val
