"""Feature views: named, versioned feature queries with keys and a time column."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.asof import point_in_time
from millrace.operators.rangebuckets import null_safe_join
from millrace.sources.versions import VersionedTable, children, exists
from millrace.streaming.incremental import FeatureRefresh


@dataclass(frozen=True)
class Entity:
    name: str
    join_keys: tuple[str, ...]
    description: str = ""


@dataclass
class FeatureView:
    name: str
    entity: Entity
    frame: DataFrame
    timestamp_col: str | None = None
    description: str = ""
    feature_descriptions: dict[str, str] = field(default_factory=dict)
    version: str | None = None
    refresh_every: str | None = None

    @property
    def features(self) -> list[str]:
        return [c for c in self.frame.columns if c not in self.entity.join_keys and c != self.timestamp_col]

    def describe_features(self, descriptions: dict[str, str]) -> FeatureView:
        """Descriptions travel as column metadata."""
        unknown = set(descriptions) - set(self.features)
        if unknown:
            raise ValueError(f"not features of {self.name}: {sorted(unknown)}")
        frame = self.frame
        for name, text in descriptions.items():
            frame = frame.withMetadata(name, {"comment": text})
        return replace(self, frame=frame, feature_descriptions={**self.feature_descriptions, **descriptions})

    def slice(self, names: Sequence[str]) -> FeatureView:
        """The same view with some of its features; only these are read from storage."""
        kept = [*self.entity.join_keys, *([self.timestamp_col] if self.timestamp_col else []), *names]
        notes = {n: t for n, t in self.feature_descriptions.items() if n in names}
        return replace(self, frame=self.frame.select(*kept), feature_descriptions=notes)


class FeatureStore:
    """Views materialised under ``<root>/views/<name>/version=<v>``, with one catalogue entry each."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _table(self, name: str) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/views", name)

    def _entry(self, name: str, version: str) -> str:
        return f"{self.root}/catalogue/{name}/version={version}"

    def register(self, view: FeatureView, version: str) -> FeatureView:
        """Materialise a version. A registered version is immutable, so an existing one is an error."""
        stored = self._table(view.name).snapshot(view.frame, version)
        entry = json.dumps({
            "name": view.name, "version": version, "entity": view.entity.name, "entity_description": view.entity.description,
            "keys": list(view.entity.join_keys), "timestamp_col": view.timestamp_col, "description": view.description,
            "features": view.feature_descriptions, "refresh_every": view.refresh_every,
        })
        self.spark.createDataFrame([(entry,)], "value string").coalesce(1).write.text(self._entry(view.name, version))
        return replace(view, frame=stored, version=version)

    def get(self, name: str, version: str | None = None) -> FeatureView:
        version = version or self._table(name).latest()
        if version is None or version not in self._table(name).versions():
            raise KeyError(f"no feature view {name} {version or ''}")
        meta = json.loads(self.spark.read.text(self._entry(name, version)).first()["value"])
        entity = Entity(meta["entity"], tuple(meta["keys"]), meta["entity_description"])
        return FeatureView(name, entity, self._table(name).read(version), meta["timestamp_col"], meta["description"],
                           meta["features"], version, meta.get("refresh_every"))

    def get_or_register(self, view: FeatureView, version: str) -> FeatureView:
        try:
            return self.get(view.name, version)
        except KeyError:
            return self.register(view, version)

    def list_views(self) -> DataFrame:
        rows = []
        for name in children(self.spark, f"{self.root}/views"):
            for version in self._table(name).versions():
                view = self.get(name, version)
                rows.append((name, version, view.entity.name, ",".join(view.entity.join_keys), view.timestamp_col,
                             view.description, ",".join(view.features)))
        return self.spark.createDataFrame(
            rows, "name string, version string, entity string, keys string, timestamp_col string, description string, features string")

    def read(self, name: str, version: str | None = None) -> DataFrame:
        """A version as it was registered; unless one is named, the newest with what was refreshed since.

        A refreshed key has the one row of its last refresh in place of its registered rows, other keys keep theirs.
        Each version is refreshed on its own, so a new version starts with its registered rows.
        """
        view = self.get(name, version)
        if version is not None or not exists(self.spark, f"{self._refreshed(view)}/features"):
            return view.frame
        fresh = FeatureRefresh(self.spark, self._refreshed(view), view.entity.join_keys, lambda rows: rows).current()
        untouched = null_safe_join(view.frame, fresh.select(*view.entity.join_keys), view.entity.join_keys, "left_anti")
        return untouched.unionByName(fresh.select(*view.frame.columns))

    def _refreshed(self, view: FeatureView) -> str:
        return f"{self.root}/refreshed/{view.name}/version={view.version}"

    def keep_fresh(self, name: str, stream: DataFrame, features: Callable[[DataFrame], DataFrame],
                   history: DataFrame | None = None, version: str | None = None):
        """Refresh a registered version (the newest unless named) for the keys that new rows of ``stream`` touch.

        ``features`` is the view's aggregation by its keys; it must give the view's columns. ``history`` holds the rows
        that the registered features were made of, and is read in the first run; it is None if the stream
        delivers those rows too. A view with ``refresh_every`` is refreshed at that interval until the returned
        streaming query is stopped; without it, one run handles what is there.
        """
        view = self.get(name, version)
        made = features(stream).columns
        if set(made) != set(view.frame.columns):
            raise ValueError(f"{name} has the columns {view.frame.columns}, not {made}")
        return FeatureRefresh(self.spark, self._refreshed(view), view.entity.join_keys, features, history).run(stream, view.refresh_every)

    def retrieve(self, spine: DataFrame, views: Sequence[FeatureView], spine_ts: str | None = None) -> DataFrame:
        """Feature values for each spine row, as of ``spine_ts`` where a view has a time column."""
        out = spine
        for timed, some in groupby(views, lambda v: bool(spine_ts and v.timestamp_col)):
            if timed:
                out = point_in_time(out, [(v.frame, v.entity.join_keys, v.timestamp_col, v.features) for v in some], spine_ts)
                continue
            for view in some:
                keys = list(view.entity.join_keys)
                out = out.join(view.frame.select(*keys, *view.features), keys, "left")
        return out

    def generate_dataset(self, name: str, spine: DataFrame, views: Sequence[FeatureView], spine_ts: str | None = None,
                         version: str = "v1") -> DataFrame:
        """Point-in-time result kept as an immutable dataset version."""
        return self.datasets(name).snapshot(self.retrieve(spine, views, spine_ts), version)

    def datasets(self, name: str) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/datasets", name)


def latest_spine(df: DataFrame, keys: Sequence[str], ts: str, name: str = "asof") -> DataFrame:
    """One row per key with its latest time: the moments to fetch features for."""
    return df.groupBy(*keys).agg(F.max(ts).alias(name))
