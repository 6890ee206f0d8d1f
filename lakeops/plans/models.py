"""SQL models and the typed landing and dimension models."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date
from pathlib import Path

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.dates import COMPACT, DASHED, calendar_columns
from lakeops.operators.normalize import conform, stamp
from lakeops.operators.publish import (
    LakeTable,
    PublishReport,
    publish_no_data,
    publish_partitions,
    publish_snapshot,
)
from lakeops.sources.scan import InputHook, register_inputs
from lakeops.sources.schemas import PARTITION_COLUMN, SCHEMAS

_NAME = r"[A-Za-z_][A-Za-z0-9_]*"
_PLACEHOLDER = re.compile(rf"\$(?:(?P<escaped>\$)|\{{(?P<braced>{_NAME})\}}|(?P<bare>{_NAME}))")


#: A date as it stands in a model's SQL: as a stamp on the result, as a date literal, quoted, or as a parameter.
_QUOTED = re.compile(r"'\$(?:\{PARTITION_DATE\}|PARTITION_DATE\b)'")
_PARAMETER = re.compile(r":partition_date\b")
_AS_DATE = re.compile(rf"\bDATE\s*(?:{_QUOTED.pattern})", re.IGNORECASE)
_STAMP = re.compile(rf"(?:{_QUOTED.pattern}|{_PARAMETER.pattern})\s+AS\s+`?dt`?(?!\w)", re.IGNORECASE)
_DAY = "_day.partition_date"
#: How the optimizer prints the relation that stands for an input's other days; it is never read.
_MARK = "LogicalRDD ["


class NotOverDays(ValueError):
    """A date model that can only be run date by date."""


def _names_date(sql: str) -> bool:
    return any("PARTITION_DATE" in (m["braced"], m["bare"]) for m in _PLACEHOLDER.finditer(sql))


def _optimized(frame: DataFrame) -> str:
    return frame._jdf.queryExecution().optimizedPlan().toString()


def _is_empty(frame: DataFrame) -> bool:
    """Whether the optimizer proves that the frame has no rows."""
    return _optimized(frame).startswith("LocalRelation <empty>")


class MissingVariableError(ValueError):
    """A template names a variable that was not given."""


def render(sql: str, variables: Mapping[str, str] | None = None) -> str:
    """Fill ``${NAME}`` or ``$NAME`` (``$$`` is a dollar sign), drop trailing ``;``.

    Values are pasted as text. Prefer named parameters (``:name``), which Spark
    binds as typed literals.
    """
    given = variables or {}
    named = {m["braced"] or m["bare"] for m in _PLACEHOLDER.finditer(sql) if not m["escaped"]}
    missing = sorted(named - set(given))
    if missing:
        raise MissingVariableError(f"No value was given for {', '.join(missing)}")

    def value(match: re.Match) -> str:
        return "$" if match["escaped"] else str(given[match["braced"] or match["bare"]])

    text = _PLACEHOLDER.sub(value, sql)
    text = text.strip().rstrip("; \t\r\n")
    if not text:
        raise ValueError("SQL is empty")
    return text


@dataclass(frozen=True)
class Model:
    """A SQL text and what it needs.

    Three kinds, told apart by the text: ``:start_date``/``:end_date`` parameters
    make a range model (selects ``dt`` from its input, any number of dates in one
    job), ``${PARTITION_DATE}`` or ``:partition_date`` a one-date model, anything
    else a snapshot.
    """

    name: str
    sql: str
    inputs: Mapping[str, InputHook] = field(default_factory=dict)
    variables: Mapping[str, str] = field(default_factory=dict)
    params: Mapping[str, object] = field(default_factory=dict)

    @classmethod
    def from_file(cls, path: str | Path, **kwargs) -> Model:
        location = Path(path)
        text = location.read_text(encoding="utf-8")
        if not text.strip():
            raise ValueError(f"{location} is empty, a model needs SQL")
        return cls(location.stem, text, **kwargs)

    @property
    def kind(self) -> str:
        if re.search(r":(start_date|end_date)\b", self.sql):
            return "range"
        if _names_date(self.sql) or _PARAMETER.search(self.sql):
            return "date"
        return "snapshot"

    def frame(self, spark: SparkSession, dates: Sequence[str] = ()) -> DataFrame | None:
        """The model's rows for the dates (one date for a date model); None without input."""
        if not register_inputs(spark, dict(self.inputs), dates):
            return None
        variables, args = dict(self.variables), dict(self.params)
        if self.kind == "date":
            if len(dates) != 1:
                raise ValueError(f"Model {self.name} needs exactly one date")
            variables["PARTITION_DATE"] = dates[0]
            if re.search(r":partition_date\b", self.sql):
                args["partition_date"] = dates[0]
        elif self.kind == "range":
            if not dates:
                raise ValueError(f"Model {self.name} needs dates")
            args |= {"start_date": min(dates), "end_date": max(dates)}
        return self._result(spark, render(self.sql, variables), args)

    def _result(self, spark: SparkSession, text: str, args: Mapping[str, object]) -> DataFrame:
        return spark.sql(text, args=dict(args)) if args else spark.sql(text)

    def _over_days(self, days: Sequence[str]) -> str | None:
        """The SQL of a date model as a lateral join with a list of days; None if the date is used in other ways.

        The date may be a quoted placeholder or a parameter. Where it only stamps ``dt``, the stamp is put on
        outside the lateral join, since Spark takes no outer reference in the select list of an aggregate.
        """
        sql, stamps = _STAMP.subn("CAST(NULL AS STRING) AS dt", self.sql)
        sql = _AS_DATE.sub(f"CAST({_DAY} AS DATE)", sql)
        sql = _QUOTED.sub(_DAY, _PARAMETER.sub(_DAY, sql))
        if _names_date(sql):
            return None
        listed = ", ".join(f"('{date.fromisoformat(day)}')" for day in days)
        columns = f"_model.* EXCEPT (dt), {_DAY} AS dt" if stamps else "_model.*"
        return f"SELECT {columns} FROM VALUES {listed} AS _day(partition_date), LATERAL ({render(sql, self.variables)}) AS _model"

    def frame_of_days(self, spark: SparkSession, days: Sequence[str]) -> DataFrame | None:
        """A date model's rows for several days in one plan, the same rows as day by day.

        That is so if the model asks each input only for the day it is run for, and returns that day's rows alone.
        Both are left to the optimizer to prove: it must drop an input's other days wherever they are read, and
        rows of another day must come out as empty. Raises :class:`NotOverDays` if the proof or the plan fails; None
        if an input has no data for any day.
        """
        if self.kind != "date":
            raise NotOverDays(f"{self.name} is no model of one date")
        text = self._over_days(days)
        if text is None:
            raise NotOverDays(f"{self.name} uses its date inside other text")
        if not self._asks_for_its_day_only(spark, days):
            raise NotOverDays(f"{self.name} reads other dates than the one it is run for")
        wanted = list(days)
        for hook in self.inputs.values():
            if hasattr(hook, "present"):
                wanted = hook.present(spark, wanted)
        if not wanted or not register_inputs(spark, dict(self.inputs), wanted):
            return None
        try:
            frame = self._result(spark, self._over_days(wanted), self.params)
            if PARTITION_COLUMN not in frame.columns:
                raise NotOverDays(f"{self.name} returns no {PARTITION_COLUMN}")
            named = self._result(spark, self._over_days(wanted).replace("SELECT ", f"SELECT {_DAY} AS _asked, ", 1), self.params)
            foreign = named.where(F.col(PARTITION_COLUMN) != F.col("_asked"))
            if not _STAMP.search(self.sql) and not _is_empty(foreign):
                raise NotOverDays(f"{self.name} may return rows of another date")
        except (AnalysisException, Py4JJavaError) as error:
            raise NotOverDays(f"{self.name} has no plan over several dates: {type(error).__name__}") from error
        return frame

    def _asks_for_its_day_only(self, spark: SparkSession, days: Sequence[str]) -> bool:
        """Whether the optimizer drops every other day of the inputs, wherever the model reads them."""
        day = days[0]
        for view, hook in self.inputs.items():
            frame = next((f for f in (hook(spark, [d]) for d in days) if f is not None), None)
            if frame is None:
                return True  # nothing to read on any day
            if PARTITION_COLUMN not in frame.columns:
                return False
            # Relations that only the plan knows: some rows of the day, and marked ones of all other days and of none. All
            # must be there, or an empty side of a join would hide what the other side reads.
            row = F.from_json(F.col("id").cast("string"), frame.schema).alias("r")
            own = spark.range(2).select(row).select("r.*").withColumn(PARTITION_COLUMN, F.lit(day))
            marked = spark.createDataFrame(spark.sparkContext.emptyRDD(), frame.schema)
            dt = F.col(PARTITION_COLUMN)
            undated = marked.withColumn(PARTITION_COLUMN, F.lit(None).cast("string"))
            every = own.unionByName(marked.where((dt < day) | (dt > day))).unionByName(undated)
            every.createOrReplaceTempView(view)
        variables, args = dict(self.variables) | {"PARTITION_DATE": day}, dict(self.params)
        if _PARAMETER.search(self.sql):
            args["partition_date"] = day
        found = self._result(spark, render(self.sql, variables), args)
        return _MARK not in _optimized(found)


def run_model(
    spark: SparkSession,
    model: Model,
    table: LakeTable,
    dates: Sequence[str] = (),
    *,
    mode: str = "overwrite",
    run_id: str | None = None,
    run_date: str | None = None,
    rebalance: bool | None = None,
) -> PublishReport:
    """Run a model and publish its rows; requested dates without rows are cleared.

    The rows of a one-date model sit together anyhow and are written where they are; those of a range model
    are gathered by date first, unless ``rebalance`` says otherwise.
    """
    frame = model.frame(spark, dates)
    if model.kind == "snapshot":
        if frame is None:
            return PublishReport(run_id or "", "skipped")
        return publish_snapshot(frame, table, run_id=run_id, run_date=run_date)
    if frame is None:
        return publish_no_data(spark, table, dates, run_id)
    spread = model.kind != "date" if rebalance is None else rebalance
    return publish_partitions(frame, table, mode=mode, requested=dates, run_id=run_id, rebalance=spread)


# --------------------------------------------------------------- landing (typed) models

#: How the text dates of each landing table are written (fixed values).
LANDING_DATE_FORMATS: Mapping[str, str] = {
    "ods_fund_etf_spot": COMPACT,
    "ods_etf_universe_whitelist": COMPACT,
    "ods_fund_etf_history": COMPACT,
    "ods_trade_date_hist": DASHED,
}


def landing_model(
    raw: DataFrame, table: str, dt: str | None = None, *, strict: bool = True
) -> DataFrame:
    """Raw text rows of a known landing table, typed as declared.

    ``dt`` is stamped when given, else taken from the input, so one job can type
    any number of dates.
    """
    typed = conform(
        raw,
        SCHEMAS[table],
        strict=strict,
        date_formats={"trade_date": LANDING_DATE_FORMATS[table]},
        keep=() if dt else (PARTITION_COLUMN,),
    )
    return stamp(typed, **{PARTITION_COLUMN: dt}) if dt else typed


# ---------------------------------------------------------------------------- dimensions


def calendar_dim(
    days: DataFrame, day_column: str = "trade_date", dt: str | None = None, compat: bool = False
) -> DataFrame:
    """Calendar attributes per day, a projection: no shuffle, one row in, one row out."""
    day = F.col(day_column).cast("date")
    partition = F.lit(dt) if dt else F.col(PARTITION_COLUMN)
    return days.select(
        day.alias("trade_date"),
        *calendar_columns(day, compat),
        partition.alias(PARTITION_COLUMN),
    )


def entity_dim(
    entities: DataFrame, flag: str = "WHITELIST", dt: str | None = None
) -> DataFrame:
    """Snapshot dimension of a list: symbol, name, enabled, flag, trade_date, dt."""
    rows = entities
    if dt and PARTITION_COLUMN in entities.columns:
        rows = entities.where(F.col(PARTITION_COLUMN) == dt)
    partition = F.lit(dt) if dt else F.col(PARTITION_COLUMN)
    return rows.select(
        "symbol",
        "name",
        "enabled",
        F.lit(flag).alias("flag"),
        "trade_date",
        partition.alias(PARTITION_COLUMN),
    )
