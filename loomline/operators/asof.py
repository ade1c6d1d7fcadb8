"""Point-in-time feature joins, latest values per entity and online lookup."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomline.functions import scalar as S
from loomline.operators.groups import lookup_join, with_last_known


@dataclass(frozen=True)
class FeatureView:
    """A feature table: entity keys, the time each row became known, and a time to live."""

    name: str
    keys: tuple[str, ...]
    timestamp_col: str
    features: tuple[str, ...]
    source: DataFrame
    ttl: timedelta | None = None
    created_col: str | None = None  # of rows with equal times the one created last counts

    def rows(self) -> DataFrame:
        """Key, time, created and feature columns of rows that have every key and a time."""
        created = [self.created_col] if self.created_col else []
        df = self.source.select(*dict.fromkeys([*self.keys, self.timestamp_col, *created, *self.features]))
        return df.dropna("any", subset=[*self.keys, self.timestamp_col])

    def ttl_micros(self) -> int | None:
        return None if self.ttl is None else self.ttl // timedelta(microseconds=1)


def _newest_first(view: FeatureView) -> list[Column]:
    """What orders rows of a view: time, time of creation, then the features themselves."""
    created = [F.col(view.created_col).alias("_created")] if view.created_col else []
    return [F.col(view.timestamp_col).alias("_at"), *created, *[F.col(c) for c in view.features]]


def as_of_join(
    entities: DataFrame, view: FeatureView, entity_ts: str = "event_timestamp",
    feature_ts: str | None = None,
) -> DataFrame:
    """For each entity row, the latest feature row at or before its time.

    Features are null when there is none or the latest one is older than the
    view's time to live (a row exactly at the limit still counts).
    ``feature_ts`` names an optional output column with the matched row's time.
    """
    return as_of_join_views(entities, [view], entity_ts, {view.name: feature_ts} if feature_ts else None)


def as_of_join_views(
    entities: DataFrame, views: Sequence[FeatureView], entity_ts: str = "event_timestamp",
    feature_ts: dict[str, str] | None = None, names: dict[tuple[str, str], str] | None = None,
) -> DataFrame:
    """The latest row at or before each entity row's time of every view, in one pass.

    All views have the same keys. Entity rows and the rows of all views are stacked, sorted
    once by key and time, and the last known row of each view is carried forward: one
    exchange however many views there are, no range join. Every view has its own time to
    live and its own tie-break by time of creation. ``feature_ts`` gives the names of columns
    for the matched rows' times by view, ``names`` new names by (view, feature). Entity rows
    with a null key or time get nulls.
    """
    keys, feature_ts, names = list(views[0].keys), feature_ts or {}, names or {}
    if any(list(v.keys) != keys for v in views):
        raise ValueError("views of one pass need the same keys")
    added = [names.get((v.name, c), c) for v in views for c in v.features] + list(feature_ts.values())
    twice = sorted({c for c in added if added.count(c) > 1 or c in entities.columns})
    if twice:
        raise ValueError(f"several columns would be named {twice}")
    payload = F.struct(*[F.col(c) for c in entities.columns])
    # rows with a null key match nothing: they are spread out instead of meeting in one task
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    plain = [f.name for f in entities.schema.fields if isinstance(f.dataType, T.AtomicType)]
    both = entities.select(
        *keys, F.when(null_key, F.xxhash64(*plain)).otherwise(0).alias("_salt"),
        F.col(entity_ts).alias("_ts"), F.lit(1).alias("_side"), payload.alias("_entity"),
    )
    for i, view in enumerate(views):
        both = both.unionByName(view.rows().select(
            *keys, F.lit(0).cast("bigint").alias("_salt"), F.col(view.timestamp_col).alias("_ts"), F.lit(0).alias("_side"),
            F.struct(*_newest_first(view)).alias(f"_row{i}"),
        ), allowMissingColumns=True)
    order = [F.col("_ts"), F.col("_side"), *[F.col(f"_row{i}") for i in range(len(views))]]
    latest = {f"_last{i}": f"_row{i}" for i in range(len(views))}
    matched = with_last_known(both, [*keys, "_salt"], order, latest).where("_side = 1")
    out = [F.col(f"_entity.{c}").alias(c) for c in entities.columns]
    times = []
    for i, view in enumerate(views):
        fresh = F.lit(True)
        if view.ttl is not None:
            fresh = S.micros("_ts") - S.micros(f"_last{i}._at") <= F.lit(view.ttl_micros())
        out += [F.when(fresh, F.col(f"_last{i}.{c}")).alias(names.get((view.name, c), c)) for c in view.features]
        if view.name in feature_ts:
            times.append(F.when(fresh, F.col(f"_last{i}._at")).alias(feature_ts[view.name]))
    return matched.select(*out, *times)


def latest_rows(view: FeatureView) -> DataFrame:
    """The newest feature row per entity; combines map-side, so hot entities are cheap."""
    latest = view.rows().groupBy(*view.keys).agg(F.max(F.struct(*_newest_first(view))).alias("_newest"))
    return latest.select(*view.keys, F.col("_newest._at").alias(view.timestamp_col), *[f"_newest.{c}" for c in view.features])


def online_lookup(
    requests: DataFrame, latest: DataFrame, view: FeatureView, now: str | None = None
) -> DataFrame:
    """Latest features for each requested entity; unknown or expired ones are null.

    ``now`` names a timestamp column of ``requests``; without it the time to live
    is not applied.
    """
    found = latest.select(*view.keys, F.col(view.timestamp_col).alias("_at"), *view.features)
    joined = lookup_join(requests, found, list(view.keys), "left")
    fresh = F.lit(True)
    if now is not None and view.ttl is not None:
        fresh = S.micros(now) - S.micros("_at") <= F.lit(view.ttl_micros())
    return joined.select(
        *requests.columns, *[F.when(fresh, F.col(c)).alias(c) for c in view.features]
    )


def _chosen(view: FeatureView, refs: Sequence[str]) -> FeatureView | None:
    wanted = [r.split(":", 1)[1] for r in refs if r.split(":", 1)[0] == view.name]
    missing = [f for f in wanted if f not in view.features]
    if missing:
        raise ValueError(f"{view.name} has no features {missing}")
    return replace(view, features=tuple(wanted)) if wanted else None


def historical_features(
    entities: DataFrame, views: Sequence[FeatureView], refs: Sequence[str],
    entity_ts: str = "event_timestamp", full_names: bool = False,
) -> DataFrame:
    """Training rows with the features named ``view:feature``, each as of the row's time.

    Views with the same keys are looked up in one pass. ``full_names`` calls every feature
    ``view__feature``, as is needed where two views have a feature of one name.
    """
    unknown = {r.split(":", 1)[0] for r in refs} - {v.name for v in views}
    if unknown:
        raise ValueError(f"unknown feature views: {sorted(unknown)}")
    passes: dict[tuple[str, ...], list[FeatureView]] = {}
    for view in views:
        chosen = _chosen(view, refs)
        if chosen is not None:
            passes.setdefault(chosen.keys, []).append(chosen)
    for group in passes.values():
        names = {(v.name, c): f"{v.name}__{c}" for v in group for c in v.features} if full_names else None
        entities = as_of_join_views(entities, group, entity_ts, names=names)
    return entities


def online_features(
    requests: DataFrame, views: Sequence[FeatureView], refs: Sequence[str],
    latest: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Latest values of the features named ``view:feature`` for each requested entity.

    ``latest`` maps a view's name to its materialized table; without it the latest
    rows are taken from the view's source.
    """
    for view in views:
        chosen = _chosen(view, refs)
        if chosen is not None:
            table = (latest or {}).get(view.name)
            requests = online_lookup(requests, latest_rows(chosen) if table is None else table, chosen)
    return requests
