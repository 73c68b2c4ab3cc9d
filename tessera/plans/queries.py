"""Every registered query: name -> builder(src, as_of) -> DataFrame."""

from __future__ import annotations


def all_queries() -> dict:
    from tessera.plans.analytics import ANALYTICS
    from tessera.plans.catalog import MARTS
    out = {name: fn for name, fn, _ in MARTS}
    out.update(ANALYTICS)
    for mod_name in ("tessera.plans.pages", "tessera.plans.quality", "tessera.plans.backfill",
                     "tessera.plans.jobs", "tessera.streaming.volume", "tessera.streaming.incremental", "tessera.plans.star",
                     "tessera.sources.schemas"):
        try:
            mod = __import__(mod_name, fromlist=["QUERIES"])
        except ModuleNotFoundError:
            continue
        out.update(getattr(mod, "QUERIES", {}))
    return out
