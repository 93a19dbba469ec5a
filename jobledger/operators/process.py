"""User handlers over job tables.

One ``mapInPandas`` pass, no shuffle: each task decodes its rows' args and
calls the handler registered for the row's type, wrapped in the middleware
chain. The output schema is fixed; a row that cannot be decoded, a handler
exception and a result that cannot be encoded never fail the task (they become
the row's error); with recovery off a handler's exception does.

Handlers are user code, so this is the one place rows go through Python one
at a time; everything around it stays in Catalyst.

Delivery is at least once: when an executor is lost, Spark re-runs its tasks
and their handlers run again (as a worker re-runs a job whose visibility
timeout expired), so handlers with side effects should be idempotent, e.g.
keyed by ``(job id, attempt)``.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobledger import constants as K
from jobledger.functions import args as A
from jobledger.plans.stages import StageChain

RESULT_SCHEMA = ("job_id string, type string, state string, attempt int, result string, error_code string, "
                 "error_message string, error_retryable boolean, duration_ms double")


class NonRetryable(Exception):
    """Raise (or wrap) to mark a handler failure as not retryable."""


class JobError(Exception):
    """A handler failure whose text is reported as-is."""


def _text(value) -> str | None:
    return value if isinstance(value, str) and value else None


def _call(rec: dict, fn: Callable, recover: bool):
    """Decode one row's job, run its handler and encode the result; returns
    (result text, error_message, retryable). Args or meta that are not JSON
    and results that cannot be encoded are that row's error."""
    job = {"id": rec.get("job_id"), "type": rec.get("type"), "queue": rec.get("queue"), "attempt": rec["attempt"]}
    for name in ("args", "meta"):
        try:
            job[name] = json.loads(_text(rec.get(name)) or "{}")
        except ValueError as e:
            return None, f"invalid {name}: {e}", False
    try:
        result = fn(job)
    except NonRetryable as e:
        return None, str(e), False
    except JobError as e:
        return None, str(e), True
    except Exception as e:  # noqa: BLE001 - handler code is arbitrary
        if not recover:
            raise
        return None, f"panic in job {job.get('type')} (id={job.get('id')}): {e}", True
    try:
        return None if result is None else json.dumps(result, sort_keys=True, separators=(",", ":"), allow_nan=False), None, None
    except (TypeError, ValueError) as e:
        return None, f"result cannot be encoded: {e}", False


def _runner(handlers: dict[str, Callable], middleware: StageChain | None, on_missing: str, on_error: str,
            recover: bool):
    def run(batches):
        wrapped = {t: (middleware.wrap(fn) if middleware else fn) for t, fn in handlers.items()}
        for pdf in batches:
            out = {c: [] for c in ["job_id", "type", "state", "attempt", "result", "error_code",
                                   "error_message", "error_retryable", "duration_ms"]}
            for rec in pdf.to_dict("records"):
                jid, typ = rec.get("job_id"), rec.get("type")
                attempt = rec.get("attempt")
                attempt = 0 if attempt is None or attempt != attempt else int(attempt)  # NULL may arrive as NaN
                fn = wrapped.get(typ)
                result = err = rty = None
                dur = None
                if fn is None:
                    if on_missing == "complete":
                        state = "completed"
                    else:
                        state = "failed"
                        err = f'no handler registered for job type "{typ}"'
                        rty = on_missing in ("retry", "fail_item")
                else:
                    t0 = time.perf_counter_ns()
                    result, err, rty = _call({**rec, "attempt": attempt}, fn, recover)
                    dur = ((time.perf_counter_ns() - t0) // 1000) / 1000.0
                    if err is None:
                        state = "completed"
                    else:
                        state = "discarded" if on_error == "discard" else "failed"
                out["job_id"].append(jid)
                out["type"].append(typ)
                out["state"].append(state)
                out["attempt"].append(attempt)
                out["result"].append(result)
                out["error_code"].append(K.ERR_HANDLER_ERROR if err is not None else None)
                out["error_message"].append(err)
                out["error_retryable"].append(rty if err is not None else None)
                out["duration_ms"].append(dur)
            yield pd.DataFrame(out)
    return run


def _args(cols: set) -> Column:
    """A job's args as JSON object text: from the decoded map where there is
    one, else from the text, which may be the wire's array."""
    if "args_map" in cols:
        return F.to_json(F.col("args_map"))
    if "args" not in cols:
        return F.lit(None).cast("string")
    wire = F.to_json(A.decode_args("args"))
    return F.when(F.col("args").rlike(r"^\s*\["), F.coalesce(wire, F.col("args"))).otherwise(F.col("args"))


def _columns(jobs: DataFrame) -> list[Column]:
    cols = set(jobs.columns)
    return [F.col("job_id").cast("string").alias("job_id"), F.col("type"),
            (F.col("queue") if "queue" in cols else F.lit(None).cast("string")).alias("queue"),
            (F.col("attempt") if "attempt" in cols else F.lit(0)).cast("int").alias("attempt"),
            _args(cols).alias("args"),
            (F.col("meta") if "meta" in cols else F.lit(None).cast("string")).alias("meta")]


def process(jobs: DataFrame, handlers: dict[str, Callable], on_missing: str = "error",
            on_error: str = "nack", middleware: StageChain | None = None, recover: bool = True,
            carry: tuple = (), skip: str | None = None) -> DataFrame:
    """X1 (+X2): run handlers over ``jobs`` (``job_id, type, queue, attempt,
    args (JSON object or wire array text) or args_map, meta``). ``on_missing``: ``error`` (failed,
    not retryable), ``fail_item`` / ``retry`` (failed, retryable) or
    ``complete``; ``on_error``: ``nack`` (failed) or ``discard``. Error code
    is always ``handler_error``; ``NonRetryable`` -> not retryable,
    ``JobError`` -> its text, any other exception -> the panic text.

    ``carry`` names columns of any type that each row's outcome keeps; they
    pass the handlers as Arrow arrays, untouched. A row in which ``skip`` (one
    of them) is not NULL runs no handler; its outcome is NULL but for id and
    type."""
    run = _runner(handlers, middleware, on_missing, on_error, recover)
    if not carry:
        return jobs.select(*_columns(jobs)).mapInPandas(run, RESULT_SCHEMA)
    n, kinds = len(_columns(jobs)), dict(jobs.dtypes)

    def each(batches):
        import pyarrow as pa

        types = [pa.string(), pa.string(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.bool_(), pa.float64()]
        for batch in batches:
            own = pa.RecordBatch.from_arrays(batch.columns[:n], names=batch.schema.names[:n]).to_pandas()
            now = batch.column(n + carry.index(skip)).is_null().to_numpy(zero_copy_only=False) if skip else [True] * len(own)
            ran = next(run([own[now]]))
            out = ran.set_axis(own.index[now]).reindex(own.index).astype(object)
            out[["job_id", "type"]] = own[["job_id", "type"]]
            cols = [pa.Array.from_pandas(out[c].where(out[c].notna(), None), type=t) for c, t in zip(out.columns, types)]
            yield pa.RecordBatch.from_arrays([*cols, *batch.columns[n:]], names=[*out.columns, *carry])

    schema = RESULT_SCHEMA + "".join(f", `{c}` {kinds[c]}" for c in carry)
    return jobs.select(*_columns(jobs), *carry).mapInArrow(each, schema)


def drain(jobs: DataFrame, handlers: dict[str, Callable], middleware: StageChain | None = None) -> DataFrame:
    """Run every ``available`` job once: attempt + 1, failure ->
    ``discarded``, success or no handler -> ``completed``; other jobs are
    returned unchanged with ``performed = false``."""
    run = _runner(handlers, middleware, "complete", "discard", True)
    cols = _columns(jobs)

    def each(batches):
        for pdf in batches:
            now = (pdf["_state"] == "available").fillna(False).astype(bool)
            names = ["job_id", "type", "state", "attempt", "result", "error_message"]
            if now.any():
                for ran in run([pdf[now].assign(attempt=pdf["attempt"][now].fillna(0) + 1)]):
                    yield pd.DataFrame({n: ran[n].tolist() for n in names}).assign(performed=True)
            if not now.all():
                rest = pdf[~now].assign(state=pdf["_state"], result=None, error_message=None)
                yield pd.DataFrame({n: rest[n].tolist() for n in names}).assign(performed=False)

    return jobs.select(*cols, F.col("state").alias("_state")).mapInPandas(
        each, "job_id string, type string, state string, attempt int, result string, error_message string, performed boolean")
