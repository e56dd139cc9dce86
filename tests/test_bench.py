"""The benchmark times what the job writes by default."""

from __future__ import annotations

import inspect

import pytest

import bench
from paylater.plans import warehouse


def test_bench_builds_the_default_layout(monkeypatch):
    class Built(Exception):
        pass

    build = inspect.signature(warehouse.build_warehouse)

    def record(*args, **named):
        held = build.bind(*args, **named)
        held.apply_defaults()
        raise Built(held.arguments["partition_facts_by_day"])

    monkeypatch.setattr(bench.warehouse, "build_warehouse", record)
    monkeypatch.setattr(bench, "shared_dir", lambda spark, name: name)
    monkeypatch.setattr(bench, "bronze_frames", lambda sources, ctx: {})
    with pytest.raises(Built) as got:
        bench.run_all(None, {})
    assert got.value.args == (build.parameters["partition_facts_by_day"].default,)
