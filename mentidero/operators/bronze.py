"""RAW to BRONZE: rename, prune and type each entity to its full fixed schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentidero.functions.casts import lenient
from mentidero.schemas import BRONZE


def to_bronze(raw: DataFrame, entity: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """A narrow projection, equal on tables and streams. Columns missing from `raw` become typed
    nulls; `keep` names technical columns to carry along (batch, scan order)."""
    types = {f.name: f.dataType for f in raw.schema.fields}
    columns = []
    for source, name, kind in BRONZE[entity]:
        value = lenient(F.col(source), kind, types[source]) if source in types else F.lit(None).cast(kind)
        columns.append(value.alias(name))
    return raw.select(*columns, *keep)


def rejected_lines(raw: DataFrame) -> DataFrame:
    """Lines that did not parse as JSON."""
    return raw.where(F.col("_corrupt_record").isNotNull()).select("_corrupt_record")
