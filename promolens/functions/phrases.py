"""Sets of phrases, found as substrings.

``found`` walks a whole text once with an automaton of all phrases (Arrow batches; a text takes time in proportion to its length, however many phrases there
are) and gives the numbers of the phrases that occur. It can't stand inside a lambda. ``pattern`` is for short texts and lambdas: one regular
expression, a trie of the phrases whose branches are chosen by character classes, so that a position costs a few tests instead of one for each phrase.
"""

from __future__ import annotations

import functools
import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def least(phrases: list[str]) -> list[str]:
    """The phrases that hold no other one: a text holds any phrase if and only if it holds one of them."""
    each = list(dict.fromkeys(phrases))
    return [p for p in each if not any(q != p and q in p for q in each)]


def _quoted(x: str) -> str:
    return re.sub(r"([^\w\s])", r"\\\1", x)


def _branch(items: list[tuple[str, dict]]) -> str:
    if len(items) == 1:
        return _quoted(items[0][0]) + _rest(items[0][1])
    if len(items) <= 3:
        return "(?:" + "|".join(_quoted(c) + _rest(n) for c, n in items) + ")"
    first, second = items[: len(items) // 2], items[len(items) // 2 :]
    return f"(?:(?=[{''.join(_quoted(c) for c, _ in first)}]){_branch(first)}|{_branch(second)})"


def _rest(node: dict) -> str:
    return _branch(sorted(node.items())) if node else ""


@functools.lru_cache(256)
def _pattern(phrases: tuple[str, ...]) -> str:
    short, long = [p for p in phrases if len(p) == 1], [p for p in phrases if len(p) > 1]
    root: dict = {}
    for p in long:
        functools.reduce(lambda n, c: n.setdefault(c, {}), p, root)
    gate = lambda k: "[" + "".join(_quoted(c) for c in sorted({p[k] for p in long})) + "]"
    return "|".join([*map(_quoted, short), *([f"(?={gate(0)}{gate(1)}){_branch(sorted(root.items()))}"] if long else [])])


def pattern(phrases: list[str]) -> str:
    """A pattern that is found in a text if any phrase is a substring of it."""
    if not phrases or "" in phrases:
        raise ValueError("phrases that are not empty are needed")
    return _pattern(tuple(least(phrases)))


@functools.lru_cache(64)
def _automaton(phrases: tuple[str, ...]):
    """One for each set and worker process."""
    import ahocorasick

    a = ahocorasick.Automaton()
    for k, p in enumerate(phrases):
        a.add_word(p, k)
    a.make_automaton()
    return a


def found(text: Column, phrases: list[str]) -> Column:
    """The numbers (places in the list, from 0, sorted) of the phrases that are substrings; phrases are distinct. Null texts hold none."""
    of = tuple(phrases)
    if len(set(of)) < len(of) or "" in of:
        raise ValueError("phrases must be distinct and not empty")

    def numbers(texts: pa.Array) -> pa.Array:
        a = _automaton(of)
        return pa.array([sorted({k for _, k in a.iter(t)}) if t else [] for t in texts.to_pylist()], pa.list_(pa.int32()))

    numbers.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(numbers, "array<int>")(text)
