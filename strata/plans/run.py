"""Run of one layer or of all."""

from collections.abc import Iterable

from pyspark.sql import SparkSession

from strata.plans.bronze import run_bronze
from strata.plans.gold import run_gold
from strata.plans.silver import run_silver
from strata.sources.records import Source

LAYERS = ("bronze", "silver", "gold")


def run(
    spark: SparkSession,
    layer: str = "bronze",
    sources: Iterable[Source] = (),
    force: bool = False,
    options: dict[str, dict] | None = None,
) -> dict[str, dict[str, int]]:
    """Summaries of the layers run, in order; errors in one do not stop the next.
    ``options`` holds further arguments by layer."""
    if layer not in (*LAYERS, "all"):
        raise ValueError(f"layer must be one of {LAYERS} or all, not {layer!r}")
    given = options or {}
    steps = {
        "bronze": lambda: run_bronze(spark, sources, force, **given.get("bronze", {})),
        "silver": lambda: run_silver(spark, **given.get("silver", {})),
        "gold": lambda: run_gold(spark, **given.get("gold", {})),
    }
    return {name: step() for name, step in steps.items() if layer in (name, "all")}


def failed(summary: dict[str, dict[str, int]]) -> bool:
    return any(layer["errors"] for layer in summary.values())
