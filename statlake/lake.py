"""The lake: versioned, governed datasets addressed by logical path."""

from __future__ import annotations

import datetime as dt
import json
import time
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statlake.errors import (
    DatasetNotFound,
    MissingOption,
    PermissionDenied,
    PolicyError,
    VersionExists,
    WriteExpired,
)
from statlake.functions import policy as grammar
from statlake.functions.avro import nested_fields, schema_fields
from statlake.functions.paths import check_path
from statlake.operators import access
from statlake.operators.catalog import COMMIT_FILE, DISCARD_FILE, META_FILE, list_prefix
from statlake.operators.documents import meta_json
from statlake.operators.layout import plain_scan
from statlake.operators.pseudonymize import (
    column_names,
    depseudonymize,
    pseudonymize,
    quoted,
    tokens_of,
)
from statlake.sources import tables
from statlake.sources.store import Store, Turn, age_s, new_id

# Options of the reader and writer by their string names.
_WRITE_OPTIONS = {
    "valuation": "valuation",
    "state": "state",
    "version": "version",
    "dataset-doc": "dataset_doc",
    "lineage-doc": "lineage_doc",
    "auto-repartition": "auto_repartition",
    "pseudo": "pseudo",
}


_CLAIMS = T.StructType().add("path", "string").add("version", "long").add("attempt", "string")
# Seconds after which the claim of a write that has not ended counts as dead.
CLAIM_LEASE_S = 24 * 3600.0
# The same of the short step that makes a written version visible.
COMMIT_LEASE_S = 600.0
# Partitions of a scan for each output file from which on they are merged into it without a shuffle.
MERGED = 2


@dataclass(frozen=True)
class DatasetVersion:
    """What a write created: ``uri`` names the version, its files lie in ``folder``."""

    path: str
    version: int
    uri: str
    folder: str


class Lake:
    """Datasets under one root directory.

    ``user`` switches access checks on, for reads, writes, listings and every table alike; without it
    the lake is open. ``max_partitions`` limits the files of a version; the default is no limit. ``keys`` maps the key ids of
    pseudonymization policies to secrets. A write that takes longer than ``claim_lease_s`` seconds
    counts as dead and will not be committed.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        user: str | None = None,
        keys: Mapping[str, str] | None = None,
        max_partitions: int | None = None,
        claim_lease_s: float = CLAIM_LEASE_S,
    ):
        self.spark = spark
        self.claim_lease_s = claim_lease_s
        self.root = root.rstrip("/")
        self.user = user
        self.keys = dict(keys or {})
        self.max_partitions = max_partitions

    @property
    def parent_uri(self) -> str:
        return f"{self.root}/data"

    # -- tables ------------------------------------------------------------------------------

    def _table(self, name: str, value: str | None = None) -> DataFrame:
        return tables.read_table(self.spark, self.root, name, value)

    def catalog(self) -> DataFrame:
        """One row for each committed version that the lake's user may read."""
        return self._visible(self._table("catalog"))

    def changes(self) -> DataFrame:
        """Events of the versions that the lake's user may read."""
        return self._of_visible(self._table("changes"))

    def documents(self) -> DataFrame:
        """Documents of the versions that the lake's user may read."""
        return self._of_visible(_committed(self._table("documents"), self._table("catalog")))

    def _of_visible(self, rows: DataFrame) -> DataFrame:
        """The rows that belong to versions the lake's user may read."""
        if self.user is None:
            return rows
        visible = self.catalog().select("path", "version")
        return rows.join(visible, ["path", "version"], "left_semi").select(*rows.columns)

    def grants(self) -> DataFrame:
        """All grants, or those of the lake's user."""
        return self._table("grants", self.user)

    def policies(self) -> DataFrame:
        """One row for each column a stored policy lists."""
        rows = self.documents().filter(F.col("kind") == "policy")
        entries = F.posexplode(grammar.from_policy_json(F.col("json"))).alias("position", "entry")
        return rows.select("path", "version", entries).select(
            "path",
            "version",
            "position",
            F.col("entry.var").alias("var"),
            F.col("entry.pseudoFunc").alias("pseudo_func"),
        )

    def grant(
        self,
        user: str,
        path_prefix: str,
        privilege: str = "READ",
        max_valuation: str = "SENSITIVE",
        states: list[str] | None = None,
    ) -> None:
        if privilege not in access.PRIVILEGES or max_valuation not in access.VALUATIONS:
            raise MissingOption(f"unknown privilege '{privilege}' or valuation '{max_valuation}'")
        row = {
            "user": user,
            "path_prefix": path_prefix.rstrip("/"),
            "privilege": privilege,
            "max_valuation": max_valuation,
            "states": states,
        }
        tables.append_rows(self.spark, self.root, "grants", [row])

    # -- read --------------------------------------------------------------------------------

    def read(
        self,
        path: str,
        snapshot: int = 0,
        pseudo: str | None = None,
        where: Mapping[str, object] | None = None,
    ) -> DataFrame:
        """The newest committed version of a dataset, or the newest up to a snapshot (0 = latest).

        A path that ends in ``*`` lists the catalog instead. ``pseudo`` names columns to restore:
        ``col1;col2`` uses the functions stored with the version, ``col1=f(key)`` the given one.
        ``where`` keeps the rows whose columns equal a value, or one of a list; None stands for null. For a
        restored column it gives plain values: they are enciphered once, so the scan is asked for
        their tokens and skips files and row groups by them, and only the rows found are restored.
        """
        path = check_path(path, reading=True)
        if path.endswith("*"):
            return self.list(path[:-1])
        entry = self.resolve(path, snapshot)
        reader = self.spark.read
        if entry["schema_json"] is not None:  # bulk-loaded rows may come without
            reader = reader.schema(T.StructType.fromJson(json.loads(entry["schema_json"])))
        df = reader.parquet(_folder(entry["parent_uri"], path, entry["version"], entry["attempt"]))
        policy = [] if pseudo is None else self._restoring_policy(path, entry["version"], pseudo)
        for column, wanted in (where or {}).items():
            df = self._where(df, column, wanted, policy)
        return depseudonymize(df, policy, self.keys)

    def _where(self, df: DataFrame, column: str, wanted: object, policy: list[tuple[str, str]]) -> DataFrame:
        """The rows in which a column has one of the wanted values, compared as it is stored."""
        values = list(wanted) if isinstance(wanted, list | tuple | set) else [wanted]
        plain = [v for v in values if v is not None]
        same = column_names(df)
        function = {same(var): f for var, f in policy}.get(same(column))
        stored = F.col(quoted(same(column)))
        if function is not None and plain:
            plain = tokens_of(self.spark, df.schema[same(column)].dataType, function, plain, self.keys)
        equal = stored == F.lit(plain[0]) if len(plain) == 1 else stored.isin(plain)
        return df.filter(equal | stored.isNull() if len(plain) < len(values) else equal)

    def resolve(self, path: str, snapshot: int = 0) -> Mapping:
        """The catalog row of the version that a read would see."""
        rows = self._table("catalog", path)
        if snapshot:
            rows = rows.filter(F.col("version") <= snapshot)
        columns = ("version", "parent_uri", "valuation", "state", "schema_json", "attempt")
        # one writer gets a version; should two ever have one, the earlier attempt counts for everybody
        newest = F.struct(-F.col("version"), F.col("attempt"))
        entry = rows.agg(F.min_by(F.struct(*columns), newest).alias("e")).first()["e"]
        if entry is None:
            raise DatasetNotFound(f"no dataset was found at '{path}'")
        self._check_access(path, "READ", entry["valuation"], entry["state"])
        return entry

    def list(self, prefix: str, *columns: str) -> DataFrame:
        """Paths of committed datasets that start with a prefix; more catalog columns on demand."""
        return list_prefix(self.catalog(), prefix, *columns)

    def versions(self, path: str) -> DataFrame:
        path = check_path(path, reading=False)
        rows = self._table("catalog", path)
        visible = self._visible(rows)
        if self.user is not None and visible.isEmpty() and not rows.isEmpty():
            raise PermissionDenied("Permission denied")
        return visible.select("path", "version", "valuation", "state", "created_by", "created_at")

    def accessible(self, user: str, privilege: str = "READ") -> DataFrame:
        grants = self._table("grants", user)
        return access.accessible(self._table("catalog"), grants, user, privilege)

    # -- write -------------------------------------------------------------------------------

    def save(self, df: DataFrame, path: str, options: Mapping[str, str]) -> DatasetVersion:
        """``write`` with options under their string names (``dataset-doc``, ``auto-repartition``)."""
        arguments: dict = {}
        for name, value in options.items():
            if name.lower() not in _WRITE_OPTIONS:
                raise MissingOption(f"unknown option '{name}'")
            arguments[_WRITE_OPTIONS[name.lower()]] = value
        if "auto_repartition" in arguments:
            arguments["auto_repartition"] = str(arguments["auto_repartition"]).lower() == "true"
        return self.write(df, path, **arguments)

    def write(
        self,
        df: DataFrame,
        path: str,
        valuation: str | None = None,
        state: str | None = None,
        version: int | str | None = None,
        dataset_doc: str | None = None,
        lineage_doc: str | None = None,
        auto_repartition: bool = True,
        max_partitions: int | None = None,
        pseudo: str | None = None,
        write_documents: bool = True,
    ) -> DatasetVersion:
        """Write a DataFrame as a new immutable version.

        Order: claim, metadata event, data, documents, commit event, catalog row. Every attempt has a
        folder of its own, which the catalog row names. The claim turns later writers of the version away
        before they write anything; who commits is settled by taking turns, which needs no
        atomic operation of the storage. A version without its catalog row is invisible to readers, so
        a write that dies half-way changes nothing for them and shows up in ``unfinished``.
        """
        path = check_path(path, reading=False)
        number = _version_number(version)
        if valuation is None:
            raise MissingOption("valuation is missing in options")
        if valuation not in access.VALUATIONS:
            raise MissingOption(f"valuation '{valuation}' is not one of {access.VALUATIONS}")
        if state is None:
            raise MissingOption("state is missing in options")
        if state not in access.STATES:
            raise MissingOption(f"state '{state}' is not one of {access.STATES}")
        self._check_access(path, "WRITE", valuation, state)

        shaped = self._shaped(df, max_partitions) if auto_repartition else df
        stored_policy = None
        if pseudo is not None:
            # after the rebalance, so the cipher's work is spread evenly and moved nowhere
            mappings = grammar.parse_policy(pseudo)
            shaped = pseudonymize(shaped, mappings, self.keys)
            stored_policy = mappings

        uri, attempt = f"{self.parent_uri}{path}/{number}", new_id()
        folder = _folder(self.parent_uri, path, number, attempt)
        # made before anything is written: what cannot be described must not be committed
        entry = {
            "path": path,
            "version": number,
            "parent_uri": self.parent_uri,
            "type": "BOUNDED",
            "valuation": valuation,
            "state": state,
            "created_by": self.user,
            "schema_json": shaped.schema.json(),
            "fields": schema_fields(self.spark, shaped.schema),
            "nested": nested_fields(shaped.schema),
            "attempt": attempt,
        }
        exists = VersionExists(f"version {number} of '{path}' exists already")
        store, claims = Store(self.spark), f"{self.root}/claims/{tables.key_of(path)}/{number}"
        if self._is_committed(path, number):
            raise exists
        store.put(f"{claims}/{attempt}", _json_text({"path": path, "version": number, "attempt": attempt}))
        if any(other < attempt and age_s(other) < self.claim_lease_s for other in store.names(claims)):
            store.delete(f"{claims}/{attempt}")
            raise exists
        self._event(uri, path, number, "meta", META_FILE)
        shaped.write.mode("errorifexists").parquet(folder)
        turn = Turn(store, f"{self.root}/commits/{tables.key_of(path)}/{number}", lease_s=COMMIT_LEASE_S)
        if not turn.take(settled=lambda: self._is_committed(path, number)):
            store.delete(folder)
            store.delete(f"{claims}/{attempt}")
            raise exists
        try:
            if age_s(attempt) >= self.claim_lease_s or not store.exists(f"{claims}/{attempt}"):
                raise WriteExpired(f"writing version {number} of '{path}' took longer than its claim's lease")
            if write_documents or stored_policy is not None:
                docs = (dataset_doc, lineage_doc) if write_documents else (None, None)
                self._write_documents(path, number, attempt, valuation, state, *docs, stored_policy)
            self._event(uri, path, number, "commit", COMMIT_FILE)
            tables.append_rows(self.spark, self.root, "catalog", [{**entry, "created_at": _now()}])
        finally:
            turn.release()
        store.delete(f"{claims}/{attempt}")
        return DatasetVersion(path, number, uri, folder)

    def _is_committed(self, path: str, version: int) -> bool:
        return not self._table("catalog", path).filter(F.col("version") == version).isEmpty()

    # -- upkeep ------------------------------------------------------------------------------

    def compact(self) -> None:
        """Fold the small files of the lake's tables into large ones, beside readers and writers."""
        for name in tables.SCHEMAS:
            tables.compact(self.spark, self.root, name)

    def vacuum(self, grace_s: float = tables.GRACE_S) -> int:
        """Remove files that compactions replaced more than ``grace_s`` seconds ago."""
        return sum(tables.vacuum(self.spark, self.root, name, grace_s) for name in tables.SCHEMAS)

    def unfinished(self) -> DataFrame:
        """Attempts to write a version that are not committed: running ones, and ones that died.

        One outer join of claims, events and catalog by version. ``stage`` is how far an attempt
        got, ``expired`` whether its lease is over. A claim goes when its version is committed, so the
        claims are those of running and dead writes only.
        """
        files = self.spark.read.schema("path string, version long, attempt string")
        folder = f"{self.root}/claims"
        claims = tables.rows_frame(self.spark, _CLAIMS, [])
        if Store(self.spark).exists(folder):
            files = files.option("recursiveFileLookup", "true").option("ignoreMissingFiles", "true")
            claims = files.json(folder)

        def last(kind: str) -> Column:
            return F.max(F.when(F.col("kind") == kind, F.col("ts"))).alias(kind)

        events = self._table("changes").groupBy("path", "version").agg(*map(last, ("meta", "commit", "discard")))
        done = self._table("catalog").select("path", "version", F.lit(True).alias("done"), F.col("attempt").alias("by"))
        joined = claims.join(events, ["path", "version"], "full_outer").join(done, ["path", "version"], "left")
        announced = F.col("meta").isNotNull() & (F.col("discard").isNull() | (F.col("meta") > F.col("discard")))
        open_ = F.when(F.col("attempt").isNull(), announced & F.col("done").isNull())
        open_ = open_.otherwise(F.col("done").isNull() | ~F.col("by").eqNullSafe(F.col("attempt")))
        started = F.timestamp_micros(F.split_part("attempt", F.lit("-"), F.lit(1)).cast("long"))
        since = F.coalesce(started, F.col("meta"))
        stage = F.when(F.col("done").isNotNull(), "superseded").when(F.col("commit").isNotNull(), "uncatalogued")
        limit = F.lit(_now() - dt.timedelta(seconds=self.claim_lease_s))
        rows = joined.filter(open_).select(
            "path",
            "version",
            "attempt",
            stage.when(F.col("meta").isNotNull(), "announced").otherwise("claimed").alias("stage"),
            since.alias("since"),
            (since < limit).alias("expired"),
        )
        if self.user is None:
            return rows
        # nothing is known of these versions but their paths: who may read a path at any valuation sees them
        least = rows.withColumn("valuation", F.lit(access.VALUATIONS[-1])).withColumn("state", F.lit(None).cast("string"))
        return access.accessible(least, self.grants(), self.user).select(*rows.columns)

    def orphans(self) -> DataFrame:
        """Versions that were claimed or announced but never committed."""
        return self.unfinished().filter("stage <> 'superseded'").select("path", "version").distinct()

    def discard_expired(self) -> int:
        """Remove claims and data of dead writes, so their versions can be written; returns how many.

        Only attempts whose lease is over go, and a write checks its lease before it commits, so a
        running write is never touched.
        """
        store, count = Store(self.spark), 0
        for row in self.unfinished().filter("expired").toLocalIterator():
            path, version, attempt = row["path"], row["version"], row["attempt"]
            uri = f"{self.parent_uri}{path}/{version}"
            if attempt is not None:
                store.delete(_folder(self.parent_uri, path, version, attempt))
                store.delete(f"{self.root}/claims/{tables.key_of(path)}/{version}/{attempt}")
            if row["stage"] != "superseded":
                self._event(uri, path, version, "discard", DISCARD_FILE)
            count += 1
        return count

    # -- helpers -----------------------------------------------------------------------------

    def _shaped(self, df: DataFrame, limit: int | None) -> DataFrame:
        """Evenly sized output partitions, at most ``limit`` of them if one is named.

        Adaptive execution picks the number from the data's size; the final ``coalesce`` only
        enforces the limit. Asking the DataFrame for its partition count instead would run its
        shuffles once for the question and once more for the write.

        A limit of n files makes each of n tasks write a share of all rows, at any size. The partitions
        of a plain scan, which are about even, are merged as they are read, unless they are few: in
        its files a share is several times smaller than in a shuffle.
        """
        limit = limit or self.max_partitions
        if limit is None:
            return df.hint("rebalance")
        if plain_scan(df) and df.rdd.getNumPartitions() >= MERGED * limit:
            return df.coalesce(limit)
        start = min(limit, int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        return df.hint("rebalance", start).coalesce(limit)

    def _write_documents(
        self,
        path: str,
        version: int,
        attempt: str,
        valuation: str,
        state: str,
        dataset_doc: str | None,
        lineage_doc: str | None,
        policy: list[tuple[str, str]] | None,
    ) -> None:
        meta = _one_text(
            self.spark,
            meta_json(*map(F.lit, (path, version, valuation, state)), F.lit(self.user).cast("string")),
        )
        texts = {"meta": meta, "doc": dataset_doc, "lineage": lineage_doc}
        if policy is not None:
            texts["policy"] = _json_text([{"var": v, "pseudoFunc": f} for v, f in policy])
        rows = [
            {"path": path, "version": version, "kind": kind, "json": text, "attempt": attempt}
            for kind, text in texts.items()
            if text is not None
        ]
        tables.append_rows(self.spark, self.root, "documents", rows)

    def _event(self, uri: str, path: str, version: int, kind: str, file: str) -> None:
        row = {"uri": f"{uri}/{file}", "path": path, "version": version, "kind": kind, "ts": _now()}
        tables.append_rows(self.spark, self.root, "changes", [row])

    def _visible(self, catalog: DataFrame) -> DataFrame:
        """The catalog rows that the lake's user may read."""
        if self.user is None:
            return catalog
        return access.accessible(catalog, self.grants(), self.user)

    def _check_access(self, path: str, privilege: str, valuation: str, state: str) -> None:
        if self.user is None:
            return
        grants = self.grants()
        if not access.may_access(grants, self.user, path, privilege, valuation, state):
            raise PermissionDenied("Permission denied")

    def _restoring_policy(self, path: str, version: int, pseudo: str) -> list[tuple[str, str]]:
        asked = grammar.parse_policy(pseudo)
        if all(function != grammar.UNDEFINED for _, function in asked):
            return asked
        document = (
            _committed(self._table("documents", path), self._table("catalog", path))
            .filter((F.col("version") == version) & (F.col("kind") == "policy"))
            .select(grammar.from_policy_json(F.col("json")).alias("policy"))
            .first()
        )
        stored = {m["var"]: m["pseudoFunc"] for m in document["policy"]} if document else {}
        resolved = []
        for var, function in asked:
            if function == grammar.UNDEFINED:
                if var not in stored:
                    raise PolicyError(f"no function is stored for column '{var}' of '{path}'")
                function = stored[var]
            resolved.append((var, function))
        return resolved


def _folder(parent_uri: str, path: str, version: int, attempt: str | None) -> str:
    """Where the files of a version lie: bulk-loaded versions have no attempt."""
    return f"{parent_uri}{path}/{version}" + (f"/{attempt}" if attempt else "")


def _committed(documents: DataFrame, catalog: DataFrame) -> DataFrame:
    """Documents of the attempts that were committed; bulk-loaded ones belong to none."""
    key = ["path", "version", "attempt"]
    own = documents.filter("attempt IS NOT NULL").join(catalog.select(*key), key, "left_semi")
    return own.select(*documents.columns).unionByName(documents.filter("attempt IS NULL"))


def _one_text(spark: SparkSession, text: Column) -> str:
    """The value of a column of literals; no job runs for it."""
    return tables.rows_frame(spark, T.StructType().add("path", "string"), [{"path": ""}]).select(text).first()[0]


def _json_text(value) -> str:
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"))


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def _version_number(version: int | str | None) -> int:
    if version is None or version == "":
        return time.time_ns() // 1_000_000
    text = str(version)
    if not (text.isascii() and text.isdigit()) or int(text) == 0:
        raise MissingOption(f"version '{version}' is not a positive number")
    return int(text)
