"""Weighted term sets, and their matching as column expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_MATCH = "array<struct<term:string,weight:int>>"


@dataclass(frozen=True)
class TermSet:
    """Terms with weights, in order. ``whole_words``: matched between boundaries, with an optional plural s; else as substrings."""

    terms: tuple[tuple[str, int], ...]
    whole_words: bool = True

    @classmethod
    def of(cls, terms: Iterable[str], whole_words: bool = True) -> TermSet:
        return cls(tuple((t, 1) for t in terms), whole_words)

    @property
    def names(self) -> tuple[str, ...]:
        return tuple(t for t, _ in self.terms)

    def hit(self, text: Column, term: str) -> Column:
        """Whether normalised text has a term. The substring test comes first: most terms are absent from most texts."""
        form = term.lower() if self.whole_words else re.sub(r"\s+", "", term.lower())
        found = F.contains(text, F.lit(form))
        if not self.whole_words:
            return found
        plural = "" if term.endswith("s") else "s?"
        literal = re.sub(r"([^\w\s])", r"\\\1", form)
        return found & text.rlike(rf"(?<![a-z0-9]){literal}{plural}(?![a-z0-9])")

    def matches(self, text: Column) -> Column:
        """array<struct<term, weight>> of the terms that normalised text has, in the set's order."""
        if not self.terms:
            return F.array().cast(_MATCH)
        tries = [F.when(self.hit(text, t), F.struct(F.lit(t).alias("term"), F.lit(w).alias("weight"))) for t, w in self.terms]
        return F.filter(F.array(*tries), lambda x: x.isNotNull())

    def found(self, text: Column) -> Column:
        """array<string> of the terms that normalised text has."""
        return names_of(self.matches(text))

    def any(self, text: Column) -> Column:
        return reduce(lambda a, b: a | b, (self.hit(text, t) for t in self.names), F.lit(False))

    def sql(self, text: str) -> str:
        """DuckDB expression for :meth:`matches`: a list of structs. RE2 has no look-around, boundaries are consumed instead."""
        if not self.terms:
            return "[]::STRUCT(term VARCHAR, weight INTEGER)[]"
        parts = []
        for t, w in self.terms:
            form = (t.lower() if self.whole_words else re.sub(r"\s+", "", t.lower())).replace("'", "''")
            if self.whole_words:
                plural = "" if t.endswith("s") else "s?"
                literal = re.sub(r"([^\w\s'])", r"\\\1", form)
                test = f"regexp_matches({text}, '(^|[^a-z0-9]){literal}{plural}($|[^a-z0-9])')"
            else:
                test = f"contains({text}, '{form}')"
            name = t.replace("'", "''")
            parts.append(f"CASE WHEN {test} THEN {{'term': '{name}', 'weight': {w}}} END")
        return f"list_filter([{', '.join(parts)}], lambda x: x IS NOT NULL)"


def names_of(matches: Column) -> Column:
    return F.transform(matches, lambda m: m["term"])


def score_of(matches: Column) -> Column:
    return F.aggregate(matches, F.lit(0), lambda s, m: s + m["weight"])


def union_of(*lists: Column) -> Column:
    """Ordered distinct union of lists."""
    return F.array_distinct(F.concat(*lists))
