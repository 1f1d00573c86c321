"""Enrichment by an injected function from prompts to answers, such as a language model behind a network; without one, a stub
answers from the prompt alone, so that tests and repeated runs give the same."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C

#: Prompt and attempt (from 0) to answer; it may raise. An attempt other than the first may use a stronger model.
Ask = Callable[[str, int], str]


def stub(prompt: str, attempt: int = 0) -> str:
    """The prompt's last line, cut to 120 characters: an answer that needs no model."""
    line = (prompt.strip().splitlines() or [""])[-1]
    return line if len(line) <= 120 else line[:117] + "..."


def model_for(attempt: int, models: tuple[str, ...]) -> str:
    """Models by attempt, the last one for all that follow."""
    return models[min(attempt, len(models) - 1)]


def enriched(rows: DataFrame, prompt: Column, ask: Ask = stub, accept: Callable[[str], bool] = bool, attempts: int = 3, rate: float | None = None, slots: int = 4, backoff: float = 0.0) -> DataFrame:
    """rows with answer, attempts, tokens_in, tokens_out and error (cut at 200 characters): each prompt is asked until an answer is
    accepted; what was wrong goes into the next attempt's prompt. After the last attempt the answer is null.

    rate: calls a second over all tasks. Rows are dealt to so many partitions as there are slots, so that no more tasks call at once, and each of them
    keeps a slot's share: its calls are slots / rate seconds apart, from a start of its own, so that slots don't call together. Speculative copies of a task
    would call besides, so leave spark.speculation off. backoff: seconds to wait after the first call that raises, doubled after each further one.
    Rows pass through whatever their columns' names are."""
    import pyarrow as pa

    if rate is not None and (rate <= 0 or slots < 1):
        raise ValueError("INVALID_PARAM: rate and slots must be above 0")
    held = rows.select(F.struct(*rows.columns).alias("row"), F.coalesce(prompt, F.lit("")).alias("prompt"))
    if rate is not None:
        held = held.repartition(slots)
    answer = pa.struct([("answer", pa.string()), ("attempts", pa.int32()), ("tokens_in", pa.int64()), ("tokens_out", pa.int64()), ("error", pa.string())])

    def one(text: str, wait: Callable[[], None]) -> dict:
        spent, given, error = 0, 0, None
        for attempt in range(attempts):
            asked = text if error is None else f"{text}\n\nThe last answer was not accepted: {error}"
            spent += len(asked.split())
            wait()
            try:
                got = ask(asked, attempt)
            except Exception as e:  # whatever the injected function raises is its answer's error
                error = f"{type(e).__name__}: {e}"[:200]
                if attempt + 1 < attempts:
                    time.sleep(backoff * 2**attempt)
                continue
            given += len((got or "").split())
            if accept(got):
                return {"answer": got, "attempts": attempt + 1, "tokens_in": spent, "tokens_out": given, "error": None}
            error = "not accepted"
        return {"answer": None, "attempts": attempts, "tokens_in": spent, "tokens_out": given, "error": error}

    def turns() -> Callable[[], None]:
        """Waits for this task's next turn."""
        if rate is None:
            return lambda: None
        due = time.monotonic() + TaskContext.get().partitionId() % slots / rate

        def wait() -> None:
            nonlocal due
            now = time.monotonic()
            if due > now:
                time.sleep(due - now)
            due = max(due, now) + slots / rate  # turns that were missed are lost

        return wait

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wait = turns()
        for batch in batches:
            found = pa.array([one(p, wait) for p in batch.column(1).to_pylist()], answer)
            yield pa.RecordBatch.from_arrays([batch.column(0), found], names=["row", "x"])

    fields = held.schema["row"].dataType.simpleString()
    done = held.mapInArrow(run, f"row {fields}, x struct<answer:string,attempts:int,tokens_in:long,tokens_out:long,error:string>")
    return done.select("row.*", "x.*")


def with_fallback(answers: DataFrame, fallback: Column, out: str = "abstract") -> DataFrame:
    """answers with their answer in a column, or the fallback's text where there is none."""
    return answers.withColumn(out, F.coalesce(F.nullif(F.trim("answer"), F.lit("")), fallback))


def field_prompt(name: Column, text: Column) -> Column:
    return F.format_string("Describe the register field %s in one sentence.\n%s", name, F.coalesce(text, F.lit("")))


def section_prompt(title: Column, text: Column, words: int = 500) -> Column:
    return F.format_string("Summarise the section %s in two sentences.\n%s", title, C.cap_words(F.coalesce(text, F.lit("")), words))


def validation_prompt(question: Column, answer: Column) -> Column:
    return F.format_string("Rate from 0 to 100 how well the answer fits. Reply as JSON with score and valid.\nQuestion: %s\nAnswer: %s", question, answer)


def passed(reply: Column, least: int = 70) -> Column:
    """Whether a validation reply (JSON with score and valid) says yes."""
    read = F.from_json(reply, "score int, valid boolean")
    return F.coalesce((read["score"] >= least) & read["valid"], F.lit(False))


def usage(answers: DataFrame) -> DataFrame:
    """One row: calls, answered, failed, tokens in and out."""
    zero = F.lit(0)
    return answers.agg(F.coalesce(F.sum("attempts"), zero).alias("calls"), F.count("answer").alias("answered"), F.count_if(F.col("answer").isNull()).alias("failed"), F.coalesce(F.sum("tokens_in"), zero).alias("tokens_in"), F.coalesce(F.sum("tokens_out"), zero).alias("tokens_out"))


def completed(answers: DataFrame, least_chars: int = 1) -> DataFrame:
    """answers with status COMPLETED or FAILED by whether there is an answer of enough characters."""
    return answers.withColumn("status", F.when(F.length(F.coalesce("answer", F.lit(""))) >= least_chars, "COMPLETED").otherwise("FAILED"))
