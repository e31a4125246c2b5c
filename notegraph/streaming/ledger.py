"""The evidence ledger: a step over tables, and the same state kept by a stream."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notegraph.functions.text import decay

# fixed values: half-life in days, evidence that promotes, evidence below which a key is forgotten
HALF_LIFE, BAR, FLOOR = 30.0, 1.0, 0.1


def ledger_step(state: DataFrame, sightings: DataFrame, now: Column, half_life: float = HALF_LIFE, bar: float = BAR, floor: float = FLOOR) -> DataFrame:
    """One run: decay what is kept, add the sightings, promote what crosses the bar (once), evict what fell below the floor.

    Both tables are keyed by ``key`` with evidence, seen and last_seen; the state also has promoted. ``newly`` marks
    keys that this run promoted. What was promoted stays, however weak, so it is not promoted again. Anchors are
    gathered over the runs and the last signature is kept, where the tables have ``anchors`` or ``signature``.
    """
    extra = [c for c in ("anchors", "signature") if c in state.columns or c in sightings.columns]
    kinds = {"anchors": "array<string>", "signature": "string"}
    has = lambda df, c: F.col(c) if c in df.columns else F.lit(None).cast(kinds[c])
    old = state.select("key", *[F.col(c).alias(f"o_{c}") for c in ("evidence", "seen", "last_seen", "promoted")], *[has(state, c).alias(f"o_{c}") for c in extra])
    days = (now.cast("timestamp").cast("double") - F.col("o_last_seen").cast("timestamp").cast("double")) / 86400
    kept = F.coalesce(decay(F.col("o_evidence"), days, half_life), F.lit(0.0))
    both = old.join(sightings.select("key", "evidence", "seen", "last_seen", *[has(sightings, c).alias(c) for c in extra]), "key", "full")
    none = F.array().cast("array<string>")
    more = {"anchors": F.array_sort(F.array_union(F.coalesce("o_anchors", none), F.coalesce("anchors", none))), "signature": F.coalesce("signature", "o_signature")} if extra else {}
    e = kept + F.coalesce(F.col("evidence"), F.lit(0.0))
    before = F.coalesce(F.col("o_promoted"), F.lit(False))
    out = both.select(
        "key",
        e.alias("evidence"),
        (F.coalesce(F.col("o_seen"), F.lit(0)) + F.coalesce(F.col("seen"), F.lit(0))).alias("seen"),
        F.coalesce(F.col("last_seen"), F.col("o_last_seen")).alias("last_seen"),
        (before | (e >= bar)).alias("promoted"),
        (~before & (e >= bar)).alias("newly"),
        *[more[c].alias(c) for c in extra],
    )
    return out.where(F.col("promoted") | (F.col("evidence") >= floor))


STATE = "evidence double, seen long, last_seen timestamp, promoted boolean"
OUTPUT = "key string, evidence double, seen long, last_seen timestamp, promoted boolean"


def ledger_stream(sightings: DataFrame, half_life: float = HALF_LIFE, bar: float = BAR, floor: float = FLOOR) -> DataFrame:
    """``sightings (key, evidence, ts)`` of a stream to the state of every key that a micro-batch touched.

    Evidence decays by event time between sightings; a key's rows of one batch are taken in time order. A key that ends
    a batch below the floor without having been promoted is forgotten, and has no row.
    """

    def update(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches)).sort_values("ts")
        evidence, seen, last, promoted = state.get if state.exists else (0.0, 0, None, False)
        for e, ts in zip(rows["evidence"], rows["ts"], strict=True):
            if last is not None and half_life > 0:
                evidence *= 0.5 ** (max(0.0, (ts - pd.Timestamp(last)).total_seconds() / 86400) / half_life)
            last = ts if last is None else max(ts, pd.Timestamp(last))
            evidence, seen = evidence + float(e), seen + 1
            promoted = bool(promoted or evidence >= bar)
        if not promoted and evidence < floor:
            if state.exists:
                state.remove()
            return
        state.update((float(evidence), int(seen), last.to_pydatetime() if hasattr(last, "to_pydatetime") else last, promoted))
        yield pd.DataFrame({"key": [key[0]], "evidence": [evidence], "seen": [seen], "last_seen": [last], "promoted": [promoted]})

    return sightings.groupBy("key").applyInPandasWithState(update, OUTPUT, STATE, "update", "NoTimeout")
