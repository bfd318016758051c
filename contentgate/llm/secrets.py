"""Secret scans: fixed patterns plus a token-efficiency test for random strings.

A vocabulary trained on ordinary text encodes ordinary strings in few tokens. A stretch without white space that mixes
kinds of characters and needs a token for every two characters or fewer is taken for a random string. Known kinds of
digests and identifiers, and what the fixed patterns found, are cut out before.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import cache

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentgate.llm.common import map_texts, small_batches

# Fixed patterns and least lengths of the base kinds, in the order that breaks ties.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "random")

RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
UUID = re.compile(r"(?:[0-9A-Fa-f]{8}-(?:[0-9A-Fa-f]{4}-){3}[0-9A-Fa-f]{12})")
STAMP = re.compile(r"[0-9]{4}-?[0-9]{2}-?[0-9]{2}T[0-9][0-9:.-]*Z?")
# hex digests by their lengths, and digests in base 64 behind the name of their algorithm
HEX_DIGEST = re.compile(r"(?<![0-9A-Za-z])(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128}"
                        r"|[0-9A-F]{32}|[0-9A-F]{40}|[0-9A-F]{56}|[0-9A-F]{64}|[0-9A-F]{96}|[0-9A-F]{128})(?![0-9A-Za-z])")
BASE64_DIGEST = re.compile(r"(?i:md5[-_=:/]+(?P<m>[A-Za-z0-9+/_-]{22}(?:==)?)|sha-?1[-_=:/]+(?P<a>[A-Za-z0-9+/_-]{27}=?)|sha-?256[-_=:/]+(?P<b>[A-Za-z0-9+/_-]{43}=?)"
                           r"|sha-?384[-_=:/]+(?P<c>[A-Za-z0-9+/_-]{64})|sha-?512[-_=:/]+(?P<d>[A-Za-z0-9+/_-]{86}(?:==)?))(?![A-Za-z0-9+/=])")
PART = re.compile(r"[A-Za-z0-9+]+")
# a part of an identifier: a word in the usual cases, a number, or a word with a number behind it
NAMED = re.compile(r"(?:[A-Z]?[a-z]{1,24}|[A-Z]{1,24})[0-9]{0,6}|[0-9]{1,20}")
MOST_PER_TOKEN = 2.0
LEAST = 20  # characters of a window
CORE = 12  # characters of a finding that are no part of an identifier
SLICE = 4096

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each base kind, (start, end, kind) in order."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return ordered(found)


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def listed(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


@cache
def encoder(ranks_file: bytes, pattern: str) -> tiktoken.Encoding:
    """`ranks_file`: content of a rank file, a token in base 64 and its rank on each line."""
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks_file.splitlines())}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_starts(part: str, enc: tiktoken.Encoding) -> np.ndarray:
    """For each character of an ASCII string, whether a token starts there; long strings in slices."""
    starts = np.zeros(len(part) + 1, dtype=np.int64)
    for at in range(0, len(part), SLICE):
        lengths = [len(enc.decode_single_token_bytes(t)) for t in enc.encode_ordinary(part[at:at + SLICE])]
        starts[at + np.cumsum(lengths) - lengths] = 1
    return starts


def is_named(part: str, starts: np.ndarray) -> bool:
    """A word, a number or a word with a number, or a part that takes few tokens."""
    return NAMED.fullmatch(part) is not None or len(part) > MOST_PER_TOKEN * starts.sum()


def judged(part: str, enc: tiktoken.Encoding) -> list[tuple[int, int]]:
    """Stretches of `part` that read like random strings: the union of all windows of LEAST characters that mix lower case,
    upper case or digits and take a token for MOST_PER_TOKEN characters or fewer, widened to whole parts between
    separators, without the parts of identifiers at its ends. What is left holds CORE characters of other parts."""
    starts = token_starts(part, enc)
    code = np.frombuffer(part.encode(), np.uint8)
    kinds = [(code >= low) & (code <= high) for low, high in ((48, 57), (65, 90), (97, 122))]
    sums = [np.concatenate([[0], np.cumsum(flag)]) for flag in (starts[:-1], *kinds)]
    inside = [c[LEAST:] - c[:-LEAST] for c in sums]
    hot = (inside[0] * MOST_PER_TOKEN >= LEAST) & (sum((n > 0).astype(int) for n in inside[1:]) >= 2)
    edge = np.zeros(len(part) + 1, dtype=np.int64)
    edge[:len(hot)] += hot
    edge[LEAST:] -= hot
    edges = np.flatnonzero(np.diff(np.concatenate([[False], np.cumsum(edge)[:-1] > 0, [False]]).astype(np.int8)))
    spans, parts = [], [m.span() for m in PART.finditer(part)] if len(edges) else []
    for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
        touched = [p for p in parts if p[1] > start and p[0] < end]
        named = [is_named(part[a:b], starts[a:b]) for a, b in touched]
        while named and named[0]:
            del named[0], touched[0]
        while named and named[-1]:
            del named[-1], touched[-1]
        if sum(b - a for (a, b), n in zip(touched, named) if not n) >= CORE:
            spans.append((touched[0][0], touched[-1][1]))
    return spans


def random_spans(text: str, base: list[Span], enc: tiktoken.Encoding) -> list[Span]:
    """Random strings in the runs without white space of a text, in what base spans, UUIDs, times and digests leave of them."""
    found: list[Span] = []
    known = None
    for m in RUN.finditer(text):
        if known is None:
            known = sorted([(a, b) for a, b, _ in base] + [u.span() for kind in (UUID, STAMP, HEX_DIGEST) for u in kind.finditer(text)]
                           + [u.span(u.lastgroup) for u in BASE64_DIGEST.finditer(text)])
        at = m.start()
        for a, b in [*(k for k in known if k[1] > m.start() and k[0] < m.end()), (m.end(), m.end())]:
            if a - at >= LEAST:
                found += [(at + x, at + y, "random") for x, y in judged(text[at:a], enc)]
            at = max(at, b)
    return found


def all_spans(text: str, enc: tiktoken.Encoding) -> tuple[list[Span], list[Span]]:
    base = base_spans(text)
    return base, ordered(base + random_spans(text, base, enc))


def find_secrets(docs: DataFrame, ranks_file: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: id, n_assign, n_access, n_hex, base_sha256, spans.

    Spans are whole matches as kind:start:end in code points, end exclusive, ordered by start, then kind. base_sha256 is
    the digest of the list of base spans. A null or empty text has no span: counts 0, empty list. Ids may be null or
    repeat. Runs of any length are judged to their end.
    """
    def make():
        enc = encoder(ranks_file, pattern)

        def batch(texts):
            both = [all_spans(t, enc) for t in texts]
            count = lambda kind: [sum(s[2] == kind for s in b) for b, _ in both]
            return [count("assign"), count("access"), count("hex"), count_random(both),
                    [hashlib.sha256(listed(b).encode()).hexdigest() for b, _ in both], [listed(s) for _, s in both]]

        return batch

    def count_random(both):
        return [len(s) - len(b) for b, s in both]

    fields = [("n_assign", "bigint"), ("n_access", "bigint"), ("n_hex", "bigint"), ("n_random", "bigint"), ("base_sha256", "string"), ("spans", "string")]
    return map_texts(docs.select(F.col(id_col), F.col(text_col)), text_col, [id_col], fields, make)


def redact(docs: DataFrame, ranks_file: bytes, pattern: str, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """`docs` with every span in `text_col` replaced by `mark`; texts without a span and nulls stay as they are."""
    def clean(texts: pd.Series) -> pd.Series:
        enc = encoder(ranks_file, pattern)

        def one(text):
            if text is None:
                return None
            spans, out, at = all_spans(text, enc)[1], [], 0
            for start, end, _ in spans:
                if start >= at:
                    out += [text[at:start], mark]
                at = max(at, end)
            return "".join([*out, text[at:]]) if spans else text

        return texts.map(one, na_action=None)

    udf = F.pandas_udf(clean, "string")
    return small_batches(docs).withColumn(text_col, udf(F.col(text_col).cast("string")))
