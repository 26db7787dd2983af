"""Registry of named workloads (Spark builder + DuckDB SQL) over the driver tables."""

from __future__ import annotations

from importlib import import_module

_MODULES = ["mixture", "chat", "scoring", "runs", "windows", "vocab", "shards", "streams"]


def _load():
    qs, sql = {}, {}
    for name in _MODULES:
        mod = import_module(f"quire.workloads.{name}")
        for key, fn in mod.QUERIES.items():
            if key in qs:
                raise ValueError(f"duplicate workload {key}")
            qs[key] = fn
        sql.update(getattr(mod, "SQL", {}))
    return qs, sql


def _shipped(fn):
    def run(spark, sf_dir):
        from quire.session import ensure_checkpoint_dir, ship_package

        ship_package(spark)
        ensure_checkpoint_dir(spark)
        return fn(spark, sf_dir)

    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def queries():
    return {k: _shipped(v) for k, v in _load()[0].items()}


def oracle_sql():
    qs, sql = _load()
    return {k: v for k, v in sql.items() if k in qs}


def flagship(spark, sf_dir):
    from quire.workloads.mixture import q_mix_report

    return _shipped(q_mix_report)(spark, sf_dir)
