"""Deterministic text scoring: weighted patterns evaluated as native columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracewell.functions.columns import total

MAX_SCORE = 5.0
NO_TEXT = "no text to score"


@dataclass(frozen=True)
class Term:
    """A pattern (valid in Java and RE2 alike), its weight, and the category it speaks for.

    ``needs`` is text that every match contains: looking for it first spares
    most texts the pattern.
    """

    pattern: str
    weight: float
    category: str = ""
    needs: str = ""


def _literal(text: str) -> str:
    """SQL string literal, with quotes and backslashes escaped."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class Rubric:
    """Scores whole texts. No model, no randomness, no shuffle."""

    terms: tuple[Term, ...]

    def _hits(self, text: Column, terms: Sequence[Term]) -> Column:
        if not terms:
            return F.lit(0.0)
        lowered = F.lower(text)

        def count(t: Term) -> Column:
            hits = F.regexp_count(lowered, F.lit(t.pattern))
            return F.when(lowered.contains(t.needs), hits).otherwise(
                F.when(text.isNotNull(), 0)) if t.needs else hits

        return total([count(t) * F.lit(t.weight) for t in terms])

    def score(self, text: Column) -> Column:
        """0 to 5, higher for more and heavier hits; NULL text gives NULL."""
        return F.when(text.isNotNull(), F.least(F.lit(MAX_SCORE), self._hits(text, self.terms)))

    def rate(self, text: Column, per_words: int = 100) -> Column:
        """Like :meth:`score`, but of the hits per ``per_words`` words: long texts do not saturate."""
        words = F.greatest(F.lit(1), F.regexp_count(text, F.lit(r"\p{L}+")))
        hits = self._hits(text, self.terms) * F.lit(float(per_words)) / words
        return F.when(text.isNotNull(), F.least(F.lit(MAX_SCORE), hits))

    def holds(self, text: Column, threshold: float = 1.0) -> Column:
        """Whether the score reaches the threshold, usable in filters and joins."""
        return self.score(text) >= threshold

    def classify(self, text: Column, categories: Sequence[str], none: str = "none") -> Column:
        """Category with the highest score; earlier categories win ties, ``none`` without hits."""
        named = [c for c in categories if c != none]
        scores = F.array(*[self._hits(text, [t for t in self.terms if t.category == c]) for c in named])
        labels = F.array(*[F.lit(c) for c in named])
        best = F.array_max(scores)
        return F.when(best > 0, labels[(F.array_position(scores, best) - 1).cast("int")]).when(
            text.isNotNull(), none)

    def _hits_sql(self, text: str, terms: Sequence[Term]) -> str:
        parts = [f"regexp_count(lower({text}), {_literal(t.pattern)}) * {t.weight}D" for t in terms]
        return " + ".join(parts) or "0D"

    def sql(self, text: str) -> str:
        """SQL text of :meth:`score` for a column called ``text``."""
        return f"CASE WHEN {text} IS NOT NULL THEN least({MAX_SCORE}D, {self._hits_sql(text, self.terms)}) END"

    def classify_sql(self, text: str, categories: Sequence[str], none: str = "none") -> str:
        """SQL text of :meth:`classify`."""
        named = [c for c in categories if c != none]
        scores = "array(" + ", ".join(
            self._hits_sql(text, [t for t in self.terms if t.category == c]) for c in named) + ")"
        labels = "array(" + ", ".join(map(_literal, named)) + ")"
        return (f"CASE WHEN array_max({scores}) > 0 THEN element_at({labels}, "
                f"CAST(array_position({scores}, array_max({scores})) AS INT)) "
                f"WHEN {text} IS NOT NULL THEN {_literal(none)} END")

    def judge(self, text: Column, kind: str, threshold: float = 1.0) -> Column:
        """``struct<result, status>`` with a bool, int or double result; status '' on success."""
        score = self.score(text)
        result = {"bool": score >= threshold, "int": F.round(score).cast("bigint"), "double": score}[kind]
        return F.struct(result.alias("result"),
                        F.when(text.isNull(), NO_TEXT).otherwise("").alias("status"))


@dataclass(frozen=True)
class Field:
    """One extracted field: first match of ``pattern`` (group 1), typed, or ``default``.

    ``needs`` is text that every match contains, looked for first.
    """

    name: str
    type: str
    pattern: str
    default: str
    needs: str = ""


def extract(text: Column, fields: Sequence[Field]) -> Column:
    """Typed struct of all fields plus ``status``; no field is ever NULL.

    A ``boolean`` field says whether the pattern occurs.
    """
    out = []
    for f in fields:
        if f.type == "boolean":
            value = F.coalesce(F.regexp_like(text, F.lit(f.pattern)), F.lit(False))
        else:
            match = F.regexp_extract(text, f.pattern, 1)
            found = F.nullif(F.when(text.contains(f.needs), match) if f.needs else match, F.lit(""))
            value = F.coalesce(found.try_cast(f.type), F.lit(f.default).cast(f.type))
        out.append(value.alias(f.name))
    return F.struct(*out, F.when(text.isNull(), NO_TEXT).otherwise("").alias("status"))


def extract_sql(text: str, fields: Sequence[Field]) -> str:
    """SQL text of the fields of :func:`extract`, without its status."""
    out = []
    for f in fields:
        if f.type == "boolean":
            value = f"coalesce(regexp_like({text}, {_literal(f.pattern)}), false)"
        else:
            found = f"nullif(regexp_extract({text}, {_literal(f.pattern)}, 1), '')"
            value = f"coalesce(try_cast({found} AS {f.type}), CAST({_literal(f.default)} AS {f.type}))"
        out.append(f"{_literal(f.name)}, {value}")
    return f"named_struct({', '.join(out)})"
