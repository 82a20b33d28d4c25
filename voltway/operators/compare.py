"""What differs between two releases: their input files and their tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltway.operators.reconcile import TOLERANCE, run_status


def input_changes(before: dict, after: dict) -> list[dict]:
    """Files that were added, removed or changed: source -> file -> sha256 and rows on both sides."""
    flat = lambda inputs: {(s, n): f for s, files in inputs.items() for n, f in files.items()}
    old, new = flat(before), flat(after)
    found = []
    for key in sorted(old.keys() | new.keys()):
        a, b = old.get(key), new.get(key)
        if a and b and a["sha256"] == b["sha256"]:
            continue
        change = "changed" if a and b else "removed" if a else "added"
        found.append({"source": key[0], "file": key[1], "change": change, "rows_before": a and a["rows"], "rows_after": b and b["rows"]})
    return found


def table_differences(before: DataFrame, after: DataFrame, keys: list[str], counts: list[str], measures: list[str]) -> DataFrame:
    """keys, name, before, after of every value that differs: counts at all, measures beyond the relative tolerance.

    A key that one side lacks differs in all of its values; null equals null.
    """
    names = [*counts, *measures]
    side = lambda df, s: df.select(*keys, F.lit(True).alias(f"_{s}"), *(F.col(n).cast("double").alias(f"{s}_{n}") for n in names))
    a, b = side(before, "a"), side(after, "b").withColumnsRenamed({k: f"_{k}" for k in keys})
    same = reduce(lambda x, y: x & y, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys))
    both = a.join(b, same, "full_outer").select(*(F.when(F.col("_a").isNotNull(), F.col(k)).otherwise(F.col(f"_{k}")).alias(k) for k in keys), *(c for c in (*a.columns, *b.columns) if c[:2] in ("_a", "_b", "a_", "b_")))
    values = F.explode(F.array(*(F.struct(F.lit(n).alias("name"), F.lit(n in counts).alias("exact"), F.col(f"a_{n}").alias("before"), F.col(f"b_{n}").alias("after")) for n in names)))
    each = both.select(*keys, (F.col("_a").isNull() | F.col("_b").isNull()).alias("lone"), values.alias("v")).select(*keys, "lone", "v.*")
    scale = F.greatest(F.abs("before"), F.abs("after"), F.lit(1.0))
    near = F.when(F.col("exact"), F.col("before") == F.col("after")).otherwise(F.abs(F.col("before") - F.col("after")) <= TOLERANCE * scale)
    equal = (F.col("before").isNull() & F.col("after").isNull()) | F.coalesce(near, F.lit(False))
    return each.filter(F.col("lone") | ~equal).select(*keys, "name", "before", "after")


def compared(before: dict, after: dict, differences: DataFrame, blocking: bool = False, set_aside: bool = False) -> dict:
    """The report on two versions' states: what came in, whether outputs differ, and the status that follows."""
    inputs, differs = input_changes(before["inputs"], after["inputs"]), not differences.isEmpty()
    return {"status": run_status(blocking, bool(inputs), differs, set_aside), "input_changes": inputs, "outputs_differ": differs}
