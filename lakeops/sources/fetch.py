"""Run a user function once per work unit, and tidy what it returns."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.dates import coerce_date
from lakeops.operators.normalize import filter_date_range, project_existing, rename

ORDER_COLUMNS = ("_ingest_order", "_row_index")
CELLS = "_cells"


def _portable(fn: Callable) -> bytes:
    """The function as bytes any executor can load.

    Functions of installed packages travel by name. Those of the user's own
    modules travel with their code, since executors may not have the module.
    """
    module = sys.modules.get(getattr(fn, "__module__", None) or "")
    place = getattr(module, "__file__", None) or ""
    if module is None or module.__name__ == "__main__" or "-packages" in place:
        return cloudpickle.dumps(fn)
    cloudpickle.register_pickle_by_value(module)
    try:
        return cloudpickle.dumps(fn)
    finally:
        cloudpickle.unregister_pickle_by_value(module)


def fetch(
    units: DataFrame,
    fn: Callable,
    schema: T.StructType,
    parallelism: int | None = None,
    rows_per_batch: int = 10_000,
) -> DataFrame:
    """Call ``fn(**params)`` once per unit on the executors and stack the rows.

    ``fn`` gets the parameters its signature names (all of them with ``**kwargs``)
    and returns a pandas frame, an iterator of frames (large results stay
    bounded that way), an object with ``csv_bytes``, or None. Missing columns
    become NULL, others are dropped. CSV is read as text, so leading zeros and ``NA``
    stay what they are, and cast by Spark; empty cells are NULL. An exception fails the job.
    ``_ingest_order`` is the unit's index, ``_row_index`` the place within it.
    Small results are handed to Spark together, about ``rows_per_batch`` at a time.

    Calls may be repeated when a task is retried, so write the result down
    before using it twice.
    """
    names = schema.fieldNames()
    text_columns = [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]
    order = [T.StructField(c, T.LongType()) for c in ORDER_COLUMNS]
    #: The cells of a CSV result as they were read; Spark casts them to the declared types.
    cells = T.StructField(CELLS, T.MapType(T.StringType(), T.StringType()))
    out = T.StructType([*schema.fields, *order, cells])

    portable = _portable(fn)

    def run(batches: Iterator) -> Iterator:
        import inspect
        import io

        import numpy as np
        import pandas as pd
        from pyspark import cloudpickle

        user = cloudpickle.loads(portable)
        kinds = {name: p.kind for name, p in inspect.signature(user).parameters.items()}
        takes_any = inspect.Parameter.VAR_KEYWORD in kinds.values()

        def call(given: dict):
            """With those entries that the signature can take."""
            return user(**(given if takes_any else {name: given[name] for name in kinds.keys() & given.keys()}))

        def of_payload(payload: bytes) -> pd.DataFrame:
            text = pd.read_csv(io.BytesIO(payload), dtype=str, keep_default_na=False, na_filter=False)
            known = [c for c in text.columns if c in names]
            kept = [{k: v or None for k, v in row.items()} for row in text[known].to_dict("records")]
            return pd.DataFrame({CELLS: kept}, columns=[CELLS])

        def parts(result) -> Iterator:
            """The frames of one call, those without rows left out."""
            if result is None:
                return
            if hasattr(result, "csv_bytes"):
                result = of_payload(result.csv_bytes)
            for frame in [result] if isinstance(result, pd.DataFrame) else result:
                if frame is not None and len(frame):
                    yield frame

        held, held_rows = [], 0

        def flush():
            rows = pd.concat([part for part, _, _ in held], ignore_index=True)
            rows = rows.reindex(columns=[*names, CELLS])
            for name in text_columns:
                found = rows[name].astype(object)
                rows[name] = found.map(str).where(found.notna(), None)
            rows[CELLS] = rows[CELLS].astype(object).where(rows[CELLS].notna(), None)
            rows["_ingest_order"] = np.repeat([i for _, i, _ in held], [len(f) for f, _, _ in held])
            rows["_row_index"] = np.concatenate([np.arange(s, s + len(f)) for f, _, s in held])
            return rows[out.names]

        for batch in batches:
            for index, params in zip(batch["job_index"], batch["params"], strict=True):
                seen = 0
                for frame in parts(call(dict(params))):
                    held.append((frame, int(index), seen))
                    seen += len(frame)
                    held_rows += len(frame)
                    if held_rows >= rows_per_batch:
                        yield flush()
                        held, held_rows = [], 0
        if held:
            yield flush()

    def typed(field: T.StructField):
        own = F.col(f"`{field.name}`")
        cell = F.col(CELLS)[field.name].cast(field.dataType)
        return F.when(F.col(CELLS).isNotNull(), cell).otherwise(own).alias(field.name)

    tasks = parallelism or units.sparkSession.sparkContext.defaultParallelism
    dealt = units.select("job_index", "params").repartition(tasks, "job_index")
    return dealt.mapInPandas(run, schema=out).select(*map(typed, schema.fields), *ORDER_COLUMNS)


def standardize(
    df: DataFrame,
    names: Mapping[str, str],
    columns: Sequence[str] | None = None,
    date_column: str = "trade_date",
    start: str | None = None,
    end: str | None = None,
    compact: bool = False,
) -> DataFrame:
    """Rename, keep known columns in order, coerce the date, filter the range."""
    frame = rename(df, names)
    if columns:
        frame = project_existing(frame, columns)
    if date_column in frame.columns:
        frame = filter_date_range(frame, date_column, start, end)
        day = coerce_date(frame, date_column)
        value = F.date_format(day, "yyyyMMdd") if compact else day
        frame = frame.withColumn(date_column, value)
    return frame


__all__ = ["ORDER_COLUMNS", "fetch", "standardize"]
