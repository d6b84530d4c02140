"""Grading of recorded attempts, difficulty classes, tokens and costs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkquill.functions import scalars as S
from sparkquill.operators import attempts


def graded(attempts: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """attempts (raw, gold, ...) with the answer that was given and whether it is right."""
    return attempts.withColumn("predicted", S.final_answer(F.col("raw"))).withColumn("correct", S.grade(F.col("predicted"), F.col("gold"), tolerance))


def classified(attempts: DataFrame, keys: list[str], correct: Column) -> DataFrame:
    """Per item: attempts, right ones, and the class."""
    counts = attempts.groupBy(*keys).agg(F.count_if(correct).alias("n_correct"), F.count("*").alias("n_attempts"))
    return counts.withColumn("classification", S.classify(F.col("n_correct"), F.col("n_attempts")))


def histogram(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def counted(chunks: DataFrame) -> DataFrame:
    """Chunks and their tokens by company and year."""
    return chunks.groupBy("company", "year").agg(F.count("*").alias("n_chunks"), F.coalesce(F.sum("token_count"), F.lit(0)).cast("long").alias("n_tokens"))


def usage(attempts: DataFrame, price_in: float, price_out: float) -> DataFrame:
    """Tokens and dollars of all attempts."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    sums = attempts.agg(total("input_tokens").alias("input_tokens"), total("output_tokens").alias("output_tokens"))
    return sums.withColumn("usd", F.round(S.usd(F.col("input_tokens"), F.col("output_tokens"), price_in, price_out), 6))


def budget(n_items: Column, n_attempts: int, price_in: float, price_out: float, tokens_in: int = 1500, tokens_out: int = 200) -> Column:
    """Dollars that a run is expected to cost."""
    calls = n_items * n_attempts
    return F.round(S.usd(calls * tokens_in, calls * tokens_out, price_in, price_out), 6)


def embedding_cost(chunks: DataFrame, price: float, count: str = "token_count") -> DataFrame:
    total = F.coalesce(F.sum(count), F.lit(0)).cast("long")
    return chunks.agg(F.count("*").alias("n_chunks"), total.alias("total_tokens"), F.round(total / F.lit(1e6) * F.lit(price), 6).alias("estimated_usd"))


def calibrated(
    items: DataFrame,
    evidence: DataFrame,
    provider,
    n_attempts: int = 3,
    workers: int | None = None,
    tolerance: float = 0.01,
    ledger: str | None = None,
    policy: attempts.Policy = attempts.ANSWERS,
    **waiting,
) -> DataFrame:
    """Ask a provider for each item's answers and grade them.

    items: (ord, id, task_type, question, gold_answer), evidence: (id, evidence). ``provider(question, evidence) -> (raw,
    input tokens, output tokens)`` runs in Python workers, over ``workers`` partitions where a service bounds the calls at a
    time, else over all there are. An attempt whose call fails is empty, with its message in ``error``: at once without a
    ``ledger``; with one, a folder that ``attempts.called`` keeps, after the tries of ``policy`` with its delays, and a run that
    was stopped goes on where it ended, without repeating a call that was answered."""
    asked = items.join(evidence, "id", "left").select("ord", "id", "task_type", "question", F.col("gold_answer").alias("gold"), "evidence")
    calls = asked.withColumn("attempt", F.explode(F.sequence(F.lit(0), F.lit(n_attempts - 1)))) if n_attempts else asked.withColumn("attempt", F.lit(0)).limit(0)
    if ledger:
        answered = attempts.called(calls, ["id", "attempt"], lambda call, _: provider(call["question"], call["evidence"] or ""), ledger, policy, workers, **waiting)
    else:
        answered = _asked_once(calls, provider, workers)
    record = F.struct("attempt", "raw", "predicted", "correct", F.col("input_tokens").cast("int").alias("input_tokens"), F.col("output_tokens").cast("int").alias("output_tokens"), "error")
    out = graded(answered, tolerance).groupBy("ord", "id", "task_type").agg(F.array_sort(F.collect_list(record)).alias("attempts"))
    n_correct = F.size(F.filter("attempts", lambda a: a["correct"]))
    return out.withColumn("classification", S.classify(n_correct, F.size("attempts"))).orderBy("ord")


def _asked_once(calls: DataFrame, provider, workers: int | None) -> DataFrame:
    schema = "ord long, id string, task_type string, gold string, attempt int, raw string, input_tokens int, output_tokens int, error string"

    def each(frames):
        import pandas as pd

        for frame in frames:
            rows = []
            for r in frame.itertuples(index=False):
                error = None
                try:
                    raw, used_in, used_out = provider(r.question, r.evidence or "")
                except Exception as e:  # noqa: BLE001  the run goes on, as one failed call is one wrong attempt
                    raw, used_in, used_out, error = "", 0, 0, f"{type(e).__name__}: {e}"
                rows.append((r.ord, r.id, r.task_type, r.gold, r.attempt, raw, used_in, used_out, error))
            yield pd.DataFrame(rows, columns=["ord", "id", "task_type", "gold", "attempt", "raw", "input_tokens", "output_tokens", "error"])

    return (calls.repartition(workers) if workers else calls).mapInPandas(each, schema)
