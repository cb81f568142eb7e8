"""Landed responses as a Spark source whose partitions come from a request plan: only what is asked for is opened."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual

SCHEMA = "dataset string, unit string, d date, file string, body string"
#: Columns of a plan that filters reach.
ASKED = ("dataset", "unit", "d")
OPERATORS = {EqualTo: "eq", In: "in", GreaterThan: "gt", GreaterThanOrEqual: "ge", LessThan: "lt", LessThanOrEqual: "le", IsNull: "null", IsNotNull: "valid"}
#: Characters of bodies after which a batch is handed on.
BATCH = 8 << 20


def _file_system(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def _expression(conditions: list[tuple]):
    """The conditions, (column, operator, value) each, as one expression over a plan's rows; None without any."""
    import pyarrow.compute as pc

    whole = None
    for column, operator, value in conditions:
        c = pc.field(column)
        if operator in ("null", "valid"):
            one = c.is_null() if operator == "null" else c.is_valid()
        elif operator == "in":
            one = c.isin(list(value))
        else:
            one = {"eq": c.__eq__, "gt": c.__gt__, "ge": c.__ge__, "lt": c.__lt__, "le": c.__le__}[operator](pc.scalar(value))
        whole = one if whole is None else whole & one
    return whole


@dataclass
class Requests(InputPartition):
    """Row groups of one file of the plan."""

    file: str
    groups: tuple[int, ...]


class PlanReader(DataSourceReader):
    """Driver and workers alike see the plan by row groups: no request passes through the driver."""

    def __init__(self, options: dict):
        self.plan, self.conditions = options["plan"], []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = f.attribute[0] if len(f.attribute) == 1 else None
            operator = OPERATORS.get(type(f))
            value = getattr(f, "value", None)
            if column in ASKED and operator and not (operator not in ("null", "valid") and value is None):
                self.conditions.append((column, operator, value))
            else:
                yield f

    def _fragments(self):
        import pyarrow.dataset as ds

        files, path = _file_system(self.plan)
        return files, ds.dataset(path, filesystem=files, format="parquet")

    def partitions(self) -> list[Requests]:
        # row groups whose statistics rule the filters out are left out here
        _, plan = self._fragments()
        wanted = _expression(self.conditions)
        return [Requests(part.path, tuple(g.id for g in part.row_groups)) for f in plan.get_fragments(wanted) for part in f.split_by_row_group(wanted)] or [Requests("", ())]

    def opened(self, file: str) -> str | None:
        """The body of one response, None if its file isn't there."""
        files, path = _file_system(file)
        try:
            with files.open_input_stream(path) as f:
                return f.read().decode("utf-8", "replace")
        except FileNotFoundError:
            return None

    def read(self, partition: Requests) -> Iterator[pa.RecordBatch]:
        if not partition.file:
            return
        import pyarrow.dataset as ds

        files, _ = _file_system(self.plan)
        part = ds.ParquetFileFormat().make_fragment(partition.file, files, row_groups=list(partition.groups))
        asked = part.to_table(columns=["dataset", "unit", "d", "file"], filter=_expression(self.conditions))
        schema = pa.schema([("dataset", pa.string()), ("unit", pa.string()), ("d", pa.date32()), ("file", pa.string()), ("body", pa.string())])
        rows, size = [], 0
        for r in asked.to_pylist():
            body = self.opened(r["file"]) if r["file"] else None
            rows.append(r | {"body": body})
            size += len(body or "")
            if size > BATCH:
                yield pa.RecordBatch.from_pylist(rows, schema)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


class LandedResponses(DataSource):
    """format("landed_responses"), option plan: the folder of a plan that landed.plan() wrote. A row a request, body null where nothing has landed."""

    @classmethod
    def name(cls) -> str:
        return "landed_responses"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PlanReader:
        return PlanReader(self.options)


def plan(requests: DataFrame, files: DataFrame, path: str) -> None:
    """Writes requests (dataset, unit, d) with the landed file of each, from files (dataset, unit, d, file), as a plan sorted for its filters.

    Nulls in unit and d are values like others; of several files of a request the last by name counts.
    """
    last = files.groupBy("dataset", "unit", "d").agg(F.max("file").alias("file"))
    f = last.select(*(F.col(c).alias(f"_{c}") for c in last.columns))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ASKED]
    rows = requests.select(*ASKED).distinct().join(f, same[0] & same[1] & same[2], "left").select(*ASKED, F.col("_file").alias("file"))
    rows.repartitionByRange("dataset", "d", "unit").sortWithinPartitions("dataset", "d", "unit").write.option("parquet.block.row.count.limit", 20_000).parquet(path)


def load(spark: SparkSession, path: str) -> DataFrame:
    """The responses of a written plan. Filters on dataset, unit and d reach the plan, so other files aren't opened."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(LandedResponses)
    return spark.read.format("landed_responses").option("plan", path).load()
