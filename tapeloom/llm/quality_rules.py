"""Quality rules over whole texts, evaluated as a short-circuit cascade.

A rule has a name and a function of the text that says whether to reject it. On a sample of the
documents, Spark measures what each rule costs and what it rejects; the rules then run in
descending order of rejections per cost, and a text stops at the first that rejects it. The order
changes what is computed, never the verdict, which is that no rule rejects.

Features and rules see one text at a time: no shuffle, no group, no skew. A lost executor costs
the tasks it ran; a repeated task gives the same rows.

Null and empty texts have no words; all counts are 0. Repeated rows are judged one by one, further
columns are kept and may have any name but that of the added column.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.common import arrow

WHITE = bytes([0x20, *range(0x09, 0x0E)])
SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(0x41, 0x5B))
LETTERS = UPPER + UPPER.lower()
#: Rows that the cost and selectivity of rules are measured on, about.
SAMPLE_ROWS = 2000


class Text:
    """One text; what several rules need is computed once, when first asked for."""

    def __init__(self, text: str | None):
        self.text = text or ""
        self.raw = self.text.encode()
        self._words: list[bytes] | None = None

    @property
    def words(self) -> list[bytes]:
        if self._words is None:
            self._words = self.raw.split()
        return self._words

    def count(self, characters: bytes) -> int:
        return len(self.raw) - len(self.raw.translate(None, characters))

    @property
    def word_chars(self) -> int:
        return len(self.text) - self.count(WHITE)

    def duplicate_lines(self) -> int:
        lines = [x for x in self.raw.split(b"\n") if x.strip()]
        return len(lines) - len(set(lines))

    def repeated_words(self) -> int:
        """Words in windows of three words that stand twice or more in the text."""
        words = self.words
        if len(words) < 3:
            return 0
        number: dict[bytes, int] = {}
        ids = np.fromiter([number.setdefault(w, len(number)) for w in words], np.int64, len(words))
        if len(number) < 1 << 21:
            windows = (ids[:-2] * len(number) + ids[1:-1]) * len(number) + ids[2:]
        else:  # the product would not fit: number the pairs first
            _, pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)
            windows = pairs[:-1] * len(number) + ids[2:]
        in_order = np.sort(windows)
        twice = in_order[1:][in_order[1:] == in_order[:-1]]
        if not len(twice):
            return 0
        at = np.flatnonzero(np.isin(windows, twice))
        inside = np.zeros(len(words), bool)
        for j in range(3):
            inside[at + j] = True
        return int(inside.sum())


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Text], bool]


def symbol_heavy(t: Text) -> bool:
    """More than one symbol in ten words."""
    return 10 * t.count(SYMBOLS) > len(t.words)


def odd_words(t: Text) -> bool:
    """Words of less than 2 or more than 15 characters on average."""
    n, chars = len(t.words), t.word_chars
    return chars < 2 * n or chars > 15 * n


def repeated_lines(t: Text) -> bool:
    """More than half of the lines repeat an earlier one."""
    return 2 * t.duplicate_lines() > t.raw.count(b"\n") + 1


def shouting(t: Text) -> bool:
    """More than half of the letters A-Z and a-z are capitals."""
    return 2 * t.count(UPPER) > t.count(LETTERS)


def few_letters(t: Text) -> bool:
    """Less than half of the characters in words are letters A-Z, a-z or beyond ASCII."""
    beyond = len(t.text) - len(t.raw.translate(None, bytes(range(0x80, 0x100))))
    return 2 * (t.count(LETTERS) + beyond) < t.word_chars


RULES = (
    Rule("symbol_heavy", symbol_heavy),
    Rule("odd_words", odd_words),
    Rule("repeated_lines", repeated_lines),
    Rule("shouting", shouting),
    Rule("few_letters", few_letters),
)


def measured(docs: DataFrame, rules: tuple[Rule, ...] = RULES, rows: int = SAMPLE_ROWS, text: str = "text") -> DataFrame:
    """One row for each rule: texts, rejected, seconds, on a sample of about so many documents.

    Every rule is timed on texts of its own, so that none gains from what another computed.
    """

    def timed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {r.name: [0, 0, 0.0] for r in rules}
        for batch in batches:
            for x in batch.column(0):
                value = x.as_py()
                for r in rules:
                    t, began = Text(value), time.perf_counter()
                    rejected = r.rejects(t)
                    for i, more in enumerate((1, rejected, time.perf_counter() - began)):
                        total[r.name][i] += more
        yield pa.RecordBatch.from_pylist(
            [{"rule": k, "texts": n, "rejected": x, "seconds": s} for k, (n, x, s) in total.items()],
            pa.schema([("rule", pa.string()), ("texts", pa.int64()), ("rejected", pa.int64()), ("seconds", pa.float64())]),
        )

    total = docs.count()
    sample = docs.select(text).sample(min(1.0, rows / max(total, 1)), seed=0)
    return (
        sample.mapInArrow(timed, "rule string, texts long, rejected long, seconds double")
        .groupBy("rule")
        .agg(F.sum("texts").alias("texts"), F.sum("rejected").alias("rejected"), F.sum("seconds").alias("seconds"))
    )


def in_order(docs: DataFrame, rules: tuple[Rule, ...] = RULES, rows: int = SAMPLE_ROWS, text: str = "text") -> list[Rule]:
    """The rules by rejections per second on a sample, the best first; of equals, as given.

    One row a rule comes to the driver.
    """
    seen = {r["rule"]: r["rejected"] / max(r["seconds"], 1e-9) for r in measured(docs, rules, rows, text).collect()}
    return sorted(rules, key=lambda r: -seen.get(r.name, 0.0))


def passes(text: Column, ordered: list[Rule]) -> Column:
    """Whether no rule rejects a text; stops at the first that does."""

    def judged(column: pa.Array) -> pa.Array:
        return pa.array([not any(r.rejects(t) for r in ordered) for t in (Text(x.as_py()) for x in column)], pa.bool_())

    return arrow(judged, "boolean")(text)


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judgement(text: Column, ordered: list[Rule], min_words: int = 50, max_repeated: int = 50) -> Column:
    """The counts of a text, whether they fail the base rule, and whether the text is kept: the base
    rule holds and no rule of the cascade rejects. A text that failed the base rule skips the cascade."""
    kind = pa.struct([*((n, pa.int64()) for n in BASE), ("base_failed", pa.bool_()), ("kept", pa.bool_())])

    def judged(column: pa.Array) -> pa.Array:
        rows = []
        for x in column:
            t = Text(x.as_py())
            n, again = len(t.words), t.repeated_words()
            failed = n < min_words or 100 * again > max_repeated * n
            kept = not failed and not any(r.rejects(t) for r in ordered)
            rows.append((n, t.word_chars, t.count(SYMBOLS), t.duplicate_lines(), again, failed, kept))
        names = [f.name for f in kind]
        return pa.array([dict(zip(names, r, strict=True)) for r in rows], kind)

    return arrow(judged, ", ".join(f"{n} long" for n in BASE) + ", base_failed boolean, kept boolean")(text)


def quality(docs: DataFrame) -> DataFrame:
    """One row for each document: its id and its judgement."""
    return docs.select("doc_id", judgement(F.col("text"), in_order(docs)).alias("q")).select("doc_id", "q.*")


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with all their columns."""
    judged = docs.select(F.struct("*").alias("row"), judgement(F.col("text"), in_order(docs)).alias("q"))
    return judged.where("q.kept").select("row.*")
