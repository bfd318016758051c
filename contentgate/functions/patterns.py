"""Custom patterns over batches of texts, in time linear in the text.

Patterns are RE2's, which Arrow evaluates over a whole column without backtracking: nested groups, unbounded repetition of
groups and classes of any kind cost a bounded number of steps per character. The patterns of a set are joined into one
automaton where they compile together, and halved until they do. What only a backtracking matcher can decide (look-around,
back references) runs under a time limit. A pattern that neither can read is broken.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc

SECONDS = 1.0  # for one pattern with look-around or back references on one text
PROBE = pa.array([""])


@dataclass(frozen=True)
class PatternSet:
    """Automata that cover all linear patterns, the patterns that need backtracking, and how many are broken."""

    automata: tuple[str, ...]
    backtracking: tuple
    broken: int


@lru_cache(maxsize=100_000)
def is_linear(pattern: str) -> bool:
    try:
        pc.match_substring_regex(PROBE, pattern=pattern)
    except pa.ArrowInvalid:
        return False
    return True


@lru_cache(maxsize=10_000)
def backtracker(pattern: str):
    """A compiled pattern, or None for one that cannot be read (or where the matcher is not installed)."""
    try:
        import regex

        return regex.compile(pattern, regex.ASCII)
    except Exception:  # any complaint about the pattern: it decides nothing
        return None


def united(patterns: list[str]) -> list[str]:
    """Alternations that cover the patterns, as few as compile."""
    if not patterns:
        return []
    joined = "|".join(f"(?:{p})" for p in patterns)
    # a pattern may close the group it is put in
    if len(patterns) == 1:
        return patterns
    if is_linear(joined) and all(is_linear(f"(?:{p})") for p in patterns):
        return [joined]
    half = len(patterns) // 2
    return united(patterns[:half]) + united(patterns[half:])


@lru_cache(maxsize=10_000)
def compiled(patterns: tuple[str | None, ...]) -> PatternSet:
    """An empty or missing pattern is broken: it would match everything."""
    known = sorted({p for p in patterns if p})
    linear = [p for p in known if is_linear(p)]
    others = {p: backtracker(p) for p in known if not is_linear(p)}
    broken = sum(not p or p in others and others[p] is None for p in patterns)
    return PatternSet(tuple(united(linear)), tuple(m for m in others.values() if m is not None), broken)


def matches(texts: pa.Array, patterns: PatternSet) -> tuple[list[bool], list[int]]:
    """For each text whether any pattern matches, and how many patterns ran out of time on it. Null matches nothing."""
    hit = pa.array([False] * len(texts))
    for automaton in patterns.automata:
        hit = pc.or_(hit, pc.fill_null(pc.match_substring_regex(texts, pattern=automaton), False))
    found, late = hit.to_pylist(), [0] * len(texts)
    for matcher in patterns.backtracking:
        for k, text in enumerate(texts.to_pylist()):
            if text is not None and not found[k]:
                try:
                    found[k] = matcher.search(text, timeout=SECONDS) is not None
                except (TimeoutError, RecursionError, MemoryError):
                    late[k] += 1
    return found, late
