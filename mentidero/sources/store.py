"""Keyed Parquet tables with upsert, as bucketed parts behind one catalog view.

A batch is shuffled to the key's buckets and written as a new part, sorted by key; the stored parts aren't touched.
A row of a part is live if no other part has a row of its key that beats it, so reading is one left-anti join per
pair of parts. All parts have the same buckets: these joins need no shuffle. `compact` merges the parts bucket by
bucket into one; it is called when readers should be spared the joins, never by itself for the number of parts.

A version is a list of parts. It is published by writing the list into a folder of its own and replacing the
table's view in the catalog, in one step each; readers see the old or the new version. A run that dies before leaves
a part that no list names. Parts of older versions aren't removed, so readers of those go on.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mentidero.operators.upsert import one_per_key, split_rejects
from mentidero.schemas import STORE, store_schema
from mentidero.sources.lake import empty, or_empty

PARTS = "mentidero_parts"  # the catalog database of the parts
LIST_SCHEMA = "place INT, part STRING, mode STRING, ordered_by ARRAY<STRING>, buckets INT"
REPLACE, IGNORE, NEWEST = "replace", "ignore", "newest"


@dataclass(frozen=True)
class Part:
    """A written batch: the later of two parts decides by its mode which row of a key stays."""

    name: str
    mode: str
    order: tuple[str, ...] = ()


@dataclass
class KeyedTable:
    """`buckets` is fixed by the first batch; choose it so that a bucket is a few GB. `view`, where given, is the
    catalog name under which every version is published."""

    spark: SparkSession
    root: str
    schema: StructType
    key: str
    buckets: int = 64
    view: str | None = None
    _known: set[str] = field(default_factory=set, repr=False)

    def read(self) -> DataFrame:
        parts = self.parts()
        return self.spark.sql(self._sql(parts)) if parts else empty(self.spark, self.schema)

    def upsert(self, incoming: DataFrame, order: list[str] | None = None, unique: bool = False) -> None:
        """Replace whole rows by key (nulls too), insert the others. No rows: nothing happens. `unique` promises that
        `incoming` has one row per key already (rows without a key aside), so its rows move once, to their buckets.

        With `order`, stored columns, the row with the largest values wins, be it stored or incoming;
        an incoming row wins a tie.
        """
        stored = bool(order) and set(order) <= set(self.schema.fieldNames())
        self._add(incoming, order or [], NEWEST if stored else REPLACE, tuple(order) if stored else (), unique)

    def insert_ignore(self, incoming: DataFrame) -> None:
        """Append rows whose key is not there yet; present rows stay."""
        self._add(incoming, [], IGNORE, ())

    def compact(self) -> None:
        """One part of all live rows. The later parts, which batches brought, are merged first; the first part, the
        bulk of the table, meets them bucket by bucket where it lies."""
        parts = self.parts()
        if len(parts) < 2:
            return
        late = self._write(self.spark.sql(self._sql(parts[1:])).repartition(self.buckets, self.key), "late") if len(parts) > 2 else parts[1].name
        last = Part(late, parts[1].mode, parts[1].order)
        names = self.schema.fieldNames()
        old, new = self._table(parts[0].name), self._table(late)
        pair = [parts[0], last]
        first = self._beats(pair, 0, 1, "o", "n")  # the stored row stays
        pick = lambda c: F.when(F.col(f"n.{self.key}").isNull() | (F.col(f"o.{self.key}").isNotNull() & F.expr(first)), F.col(f"o.{c}")).otherwise(F.col(f"n.{c}")).alias(c)
        merged = old.alias("o").join(new.alias("n"), F.col(f"o.{self.key}") == F.col(f"n.{self.key}"), "full_outer").select(*[pick(c) for c in names])
        self._publish([Part(self._write(merged, "base"), REPLACE)])

    def parts(self) -> list[Part]:
        """The parts of the newest version, read by its name; none before the first batch."""
        number = self._version()
        if not number:
            return []
        rows = self.spark.read.schema(LIST_SCHEMA).json(f"{self.root}/versions/version={number}").orderBy("place").collect()
        self.buckets = rows[0]["buckets"]
        return [Part(r["part"], r["mode"], tuple(r["ordered_by"] or ())) for r in rows]

    def publish_view(self) -> None:
        """The catalog's view over the newest version, replaced in one step."""
        parts = self.parts()
        columns = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in self.schema.fields)
        body = self._sql(parts) if parts else f"SELECT {columns} WHERE false"
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.view} AS {body}")

    def _version(self) -> int:
        names = StructType.fromDDL("version INT")
        lists = or_empty(lambda: self.spark.read.schema(StructType.fromDDL(f"{LIST_SCHEMA}, version INT")).json(f"{self.root}/versions"), self.spark, names)
        return lists.agg(F.max("version")).first()[0] or 0

    def _add(self, incoming: DataFrame, order: list[str], mode: str, stored_order: tuple[str, ...], unique: bool = False) -> None:
        parts = self.parts()
        if any((p.mode, p.order) != (mode, stored_order) for p in parts[1:]):
            self.compact()  # parts of one kind only: which row of a key stays must not hang on rows that don't
            parts = self.parts()
        fresh = self._prepare(incoming, order, unique)
        name = self._write(fresh.repartition(self.buckets, self.key), mode)
        if not self._table(name).limit(1).count():
            return
        self._publish([*parts, Part(name, mode, stored_order)])

    def _prepare(self, incoming: DataFrame, order: list[str], unique: bool) -> DataFrame:
        keyed, _ = split_rejects(incoming, self.key)
        fields = set(self.schema.fieldNames())
        extra = [c for c in order if c not in fields]
        canonical = keyed.select(
            *[F.col(f.name).cast(f.dataType) if f.name in keyed.columns else F.lit(None).cast(f.dataType).alias(f.name)
              for f in self.schema.fields],
            *extra,
        ).where(F.col(self.key).isNotNull())
        kept = canonical if unique else one_per_key(canonical, [self.key], order)
        return kept.select(*self.schema.fieldNames())

    def _beats(self, parts: list[Part], i: int, j: int, a: str, b: str) -> str:
        """The SQL condition under which row `a` of part i stays before row `b` of part j, their keys being equal."""
        later = parts[max(i, j)]
        if later.mode == REPLACE:
            return str(i > j).lower()
        if later.mode == IGNORE:
            return str(i < j).lower()
        ends = [f"struct({', '.join(f'{side}.`{c}`' for c in later.order)})" for side in (a, b)]
        return f"{ends[0]} {'>=' if i > j else '>'} {ends[1]}"

    def _sql(self, parts: list[Part]) -> str:
        names = ", ".join(f"t{{i}}.`{c}`" for c in self.schema.fieldNames())
        selects = []
        for i, part in enumerate(parts):
            joins = ""
            for j, other in enumerate(parts):
                condition = "false" if i == j else self._beats(parts, j, i, f"t{j}", f"t{i}")
                if condition != "false":
                    also = "" if condition == "true" else f" AND {condition}"
                    joins += f" LEFT ANTI JOIN {self._named(other.name)} t{j} ON t{i}.`{self.key}` = t{j}.`{self.key}`{also}"
            selects.append(f"SELECT {names.format(i=i)} FROM {self._named(part.name)} t{i}{joins}")
        return " UNION ALL ".join(selects)

    def _named(self, part: str) -> str:
        """The part's catalog name; a session that doesn't know it yet is told."""
        name = f"{PARTS}.t{hashlib.md5(self.root.encode()).hexdigest()[:12]}_{part}"
        if name not in self._known:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {PARTS}")
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) "
                f"INTO {self.buckets} BUCKETS LOCATION '{self.root}/parts/{part}'"
            )
            self._known.add(name)
        return name

    def _table(self, part: str) -> DataFrame:
        return self.spark.table(self._named(part))

    def _write(self, rows: DataFrame, kind: str) -> str:
        """A new part; rows that come dealt by bucket make a file per bucket."""
        part = f"{kind}_{uuid.uuid4().hex[:12]}"
        name = f"{PARTS}.t{hashlib.md5(self.root.encode()).hexdigest()[:12]}_{part}"
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {PARTS}")
        writer = rows.write.format("parquet").bucketBy(self.buckets, self.key).sortBy(self.key)
        writer.option("path", f"{self.root}/parts/{part}").saveAsTable(name)
        self._known.add(name)
        return part

    def _publish(self, parts: list[Part]) -> None:
        number = self._version() + 1
        rows = [(i, p.name, p.mode, list(p.order), self.buckets) for i, p in enumerate(parts)]
        listed = self.spark.createDataFrame(rows, LIST_SCHEMA).coalesce(1)
        listed.write.mode("error").json(f"{self.root}/versions/version={number}")
        if self.view:
            self.publish_view()


def store_table(spark: SparkSession, root: str, table: str, buckets: int = 64, database: str | None = None) -> KeyedTable:
    schema = store_schema(table)
    view = f"{database}.{table}" if database else None
    return KeyedTable(spark, f"{root}/{table}", schema, schema.fieldNames()[0], buckets, view)


def ensure_tables(spark: SparkSession, database: str, location: str) -> None:
    """The four store tables as views over their newest versions; running it again changes nothing."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in STORE:
        store_table(spark, location, name, database=database).publish_view()


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {database}").select("tableName").orderBy("tableName")
