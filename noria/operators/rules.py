"""Ordered compound rules: many fixed replacements, each on what the ones before it left."""

from __future__ import annotations

import heapq
import uuid
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from noria.session import ship_package

# The spaced compounds of the noun lists and of whole texts, in their order.  Each is joined by leaving out its spaces.
NOUN_COMPOUNDS = [
    "비자살적 자해",
    "비자살적 자해청소년",
    "비자살적자해 청소년",
    "비자살적 자해 청소년",
    "로지스틱 회귀",
    "매개 효과",
    "분석 결과",
    "설문 조사",
    "실태 조사",
    "연구 목적",
    "자료 분석",
    "자료 수집",
    "자해 행동",
    "정서 조절",
    "정서조절 곤란",
    "정서 조절 곤란",
    "정신 건강",
    "정신건강 실태조사",
    "정신 건강 실태 조사",
    "청소년 자해",
    "청소년자해 행동",
    "청소년 자해 행동",
]
TEXT_COMPOUNDS = ["비자살적 자해", "로지스틱 회귀", "매개 효과", "정서 조절", "정신 건강", "청소년 자해", "자해 행동", "설문 조사", "실태 조사"]

#: Rules that are written as one expression; more go through the automaton, which is broadcast: at most so many.
NESTED, MOST = 32, 1_000_000

Rules = list[tuple[str, str]]


def joined(spaced: Iterable[str]) -> Rules:
    return [(s, s.replace(" ", "")) for s in spaced]


NOUN_RULES, TEXT_RULES = joined(NOUN_COMPOUNDS), joined(TEXT_COMPOUNDS)


class Cascade:
    """All rules at once, with the outcome of replacing one after the other.

    An automaton finds every rule that a text holds in one scan.  They are applied in
    their order, and after each only the places around its replacements are scanned
    again, since these may make input for later rules; a rule whose input is gone by
    its turn does nothing.
    """

    def __init__(self, rules: Rules):
        import ahocorasick

        self.rules = [(a, b) for a, b in rules if a]
        at: dict[str, list[int]] = {}
        for i, (a, _) in enumerate(self.rules):
            at.setdefault(a, []).append(i)
        self.longest = max(map(len, at), default=0)
        self.found = ahocorasick.Automaton()
        for a, places in at.items():
            self.found.add_word(a, places)
        if at:
            self.found.make_automaton()

    def __call__(self, text: str) -> str:
        if not self.rules:
            return text
        todo, last = sorted({i for _, places in self.found.iter(text) for i in places}), -1
        while todo:
            i = heapq.heappop(todo)
            if i <= last:
                continue
            last, (given, new) = i, self.rules[i]
            pieces = text.split(given)
            if len(pieces) == 1:
                continue
            text = new.join(pieces)
            at = scanned = 0
            for piece in pieces[:-1]:
                at += len(piece)
                lo, hi = max(at - self.longest, scanned - self.longest, 0), min(at + len(new) + self.longest, len(text))
                if hi > scanned:
                    for _, places in self.found.iter(text, lo, hi):
                        for j in places:
                            if j > last:
                                heapq.heappush(todo, j)
                    scanned = hi
                at += len(new)
        return text


_CASCADES: dict = {}


def _cascade(sent) -> Cascade:
    """One automaton for each broadcast and Python worker."""
    if sent.id not in _CASCADES:
        _CASCADES.clear()
        _CASCADES[sent.id] = Cascade(sent.value)
    return _CASCADES[sent.id]


class _Sent:
    """A broadcast and its name, which the workers know it by."""

    def __init__(self, spark: SparkSession, rules: Rules):
        if len(rules) > MOST:
            raise ValueError(f"over {MOST} rules")
        ship_package(spark)
        self.value_, self.id = spark.sparkContext.broadcast(rules), uuid.uuid4().hex

    @property
    def value(self) -> Rules:
        return self.value_.value


def nested(x: Column, rules: Rules) -> Column:
    for spaced, one in rules:
        x = F.replace(x, F.lit(spaced), F.lit(one))
    return x


def normalize_texts(spark: SparkSession, x: Column, rules: Rules) -> Column:
    """A text column after all rules; a null stays null."""
    if len(rules) <= NESTED:
        return nested(x, rules)
    sent = _Sent(spark, rules)

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        cascade = _cascade(sent)
        return texts.map(cascade, na_action="ignore")

    return run(x)


def normalize_arrays(spark: SparkSession, x: Column, rules: Rules) -> Column:
    """An array column whose texts are after all rules; nulls stay null."""
    if len(rules) <= NESTED:
        return F.transform(x, lambda t: nested(t, rules))
    sent = _Sent(spark, rules)

    @F.pandas_udf("array<string>")
    def run(lists: pd.Series) -> pd.Series:
        cascade, known = _cascade(sent), {None: None}

        def one(t):
            if t not in known:
                known[t] = cascade(t)
            return known[t]

        return lists.map(lambda ts: [one(t) for t in ts], na_action="ignore")

    return run(x)
