"""Repetition inside a single document (problem 10).

Every document gets a score: the share of its letters that stand in token
windows seen earlier in it, whatever the sentences (five tokens, ten in
Chinese and Japanese texts), found through hashed windows over whole Arrow
batches.  The score is cheap and only resembles the definition, which asks for
passages within sentences (or much longer ones across); which scores reject a
document is decided by risk-controlled thresholds.

Every distinct text whose score a cutoff could reject is labelled by the exact
definition (copies count once).  In each stratum, a cutoff is certified if the
Clopper-Pearson upper bound on the share of sound texts among all those it
rejects is at most ``alpha``; so the share itself, which is counted and not
estimated, is at most ``alpha``, too, and the bound speaks for further texts of
the same kind.  Cutoffs are tested in a fixed sequence from the nominal share
downwards, which stops at the first failure, and upwards with a Bonferroni
division if the nominal one rejects too many; the level ``delta`` is divided over
the strata and both directions, so with probability ``1 - delta`` no stratum
breaks its bound.  The lowest certified cutoff rejects.  A stratum without
evidence for any cutoff keeps the nominal share and is reported as not
certified.  ``risk_report`` gives the counts.

Tokens are single Chinese/Japanese characters or lower-cased words; digits,
blanks and punctuation are no tokens.  Null, empty and letterless texts have
the share 0 and are never found; repeated rows and ids come out as often as
they stand in the table.
"""

from __future__ import annotations

import functools
import math
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import materialize

WORDS, TOKENS, ACROSS = 5, 10, 20
_STOPS = ".!?。！？；;\n"
_CJK = "ぁ-ヿ㐀-䶿一-鿿豈-﫿"


@dataclass(frozen=True)
class RiskControl:
    """``share`` defines a repetitive text and is the nominal cutoff; everything is computed over all rows."""

    share: float = 1 / 3
    alpha: float = 0.02
    delta: float = 0.05
    lower: tuple[float, ...] = tuple(round(0.32 - 0.02 * i, 2) for i in range(14))
    upper: tuple[float, ...] = (0.4, 0.5, 0.6, 0.7, 0.8, 0.9)

    @property
    def floor(self) -> float:
        return min(self.share, *self.lower)


def exact_share(text: str | None) -> float:
    """Share of letters in passages that occurred earlier, on strings."""
    if not text:
        return 0.0
    tokens: list[str] = []
    sentence: list[int] = []
    for number, part in enumerate(re.split(f"[{_STOPS}]+", text.lower())):
        found = re.findall(rf"[{_CJK}]|[^\W\d_{_CJK}]+", part)
        tokens += found
        sentence += [number] * len(found)
    n = len(tokens)
    if not n:
        return 0.0
    single = [len(t) == 1 and bool(re.match(f"[{_CJK}]", t)) for t in tokens]
    covered = bytearray(n)
    for size, within in ((WORDS, True), (TOKENS, True), (ACROSS, False)):
        seen: set[tuple[str, ...]] = set()
        for i in range(n - size + 1):
            if within and sentence[i] != sentence[i + size - 1]:
                continue
            if size == WORDS and any(single[i : i + size]):
                continue
            window = tuple(tokens[i : i + size])
            if window in seen:
                covered[i : i + size] = b"\1" * size
            else:
                seen.add(window)
    letters = [len(t) for t in tokens]
    return sum(c for c, x in zip(letters, covered) if x) / sum(letters)


@functools.cache
def _classes() -> np.ndarray:
    """0 separator, 1 word letter, 2 single-character token, 3 sentence end; beyond the BMP everything separates."""
    out = np.zeros(0x10000, np.uint8)
    single = re.compile(f"[{_CJK}]")
    for cp in range(0x10000):
        ch = chr(cp)
        if single.match(ch):
            out[cp] = 2
        elif unicodedata.category(ch)[0] in "LM" and not 0xD800 <= cp <= 0xDFFF and ch.isalnum():
            out[cp] = 1
    for ch in _STOPS:
        out[ord(ch)] = 3
    return out


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


@dataclass(frozen=True)
class _Tokens:
    """Tokens of a batch of ``n`` texts: hash, letters, text, sentence and whether it is a single character."""

    n: int
    token: np.ndarray
    size: np.ndarray
    owner: np.ndarray
    sentence: np.ndarray
    single: np.ndarray

    def share(self, of: np.ndarray) -> np.ndarray:
        """Share of each text's letters in the tokens ``of``."""
        total = np.bincount(self.owner, self.size, self.n)[: self.n]
        return np.divide(np.bincount(self.owner, self.size * of, self.n)[: self.n], total, out=np.zeros(self.n), where=total > 0)

    def cover(self, covered: np.ndarray, width: int, ok: np.ndarray) -> None:
        """Adds the windows of ``width`` tokens that occurred earlier in their text; ``ok`` tells which count."""
        with np.errstate(over="ignore"):
            h = np.zeros(len(ok), np.uint64)
            for j in range(width):
                h = h * np.uint64(0x100000001B3) + self.token[j : j + len(ok)]
            where = np.flatnonzero(ok)
            key = _mix(h[where] + _mix(self.owner[where].astype(np.uint64) + np.uint64(1)))
        order = np.argsort(key, kind="stable")
        again = where[order[1:][key[order[1:]] == key[order[:-1]]]]
        np.add.at(covered, again, 1)
        np.add.at(covered, again + width, -1)


def _tokenise(texts: list[str | None]) -> _Tokens:
    joined = "\n".join((t or "").lower().replace("\n", "。") for t in texts) + "\n"
    cps = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
    doc = np.zeros(len(cps), np.int64)
    doc[1:] = np.cumsum(cps == 10)[:-1]
    kind = np.where(cps < 0x10000, _classes()[np.minimum(cps, 0xFFFF)], 0)
    letter = (kind == 1) | (kind == 2)
    first = letter & ((kind == 2) | np.concatenate([[True], (kind[1:] == 2) | (kind[:-1] != 1)]))
    at = np.flatnonzero(letter)
    start = np.flatnonzero(first[at])
    size = np.diff(np.append(start, len(at)))
    inside = np.arange(len(at)) - np.repeat(start, size)
    with np.errstate(over="ignore"):
        mixed = _mix(cps[at].astype(np.uint64) + (inside.astype(np.uint64) << np.uint64(24)))
        token = _mix(np.add.reduceat(mixed, start)) if len(start) else mixed
    return _Tokens(len(texts), token, size, doc[at][start], np.cumsum(kind == 3)[at][start], kind[at][start] == 2)


def batch_scores(texts: list[str | None], exact: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Score and share of single-character tokens of each text; on demand the share by the definition, too (on hashes)."""
    t = _tokenise(texts)
    m = len(t.token)
    if not m:
        return np.zeros(t.n), np.zeros(t.n), np.zeros(t.n) if exact else None
    cjk = t.share(t.single)
    inside = lambda width: t.owner[: m - width + 1] == t.owner[width - 1 :]
    covered = np.zeros(m + 1, np.int64)
    for width, east in ((WORDS, False), (TOKENS, True)):
        if m >= width:
            t.cover(covered, width, inside(width) & ((cjk[t.owner[: m - width + 1]] >= 0.5) == east))
    scores = t.share(np.cumsum(covered[:-1]) > 0)
    if not exact:
        return scores, cjk, None
    covered = np.zeros(m + 1, np.int64)
    for width in (WORDS, TOKENS, ACROSS):
        if m < width:
            continue
        ok = inside(width) if width == ACROSS else t.sentence[: m - width + 1] == t.sentence[width - 1 :]
        if width == WORDS:
            run = np.concatenate([[0], np.cumsum(t.single)])
            ok &= run[width:] == run[:-width]
        t.cover(covered, width, ok)
    return scores, cjk, t.share(np.cumsum(covered[:-1]) > 0)


def stratum_of(cjk: float, length: int) -> str:
    """Strata of the thresholds: script by length."""
    return ("cjk" if cjk >= 0.5 else "latin") + ("-long" if length > 1000 else "-short")


def binomial_upper(bad: int, n: int, confidence: float) -> float:
    """Exact (Clopper-Pearson) upper bound on a rate, by bisection."""
    if n == 0 or bad >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) for i in range(bad + 1)]
    low, high = bad / n, 1.0
    for _ in range(60):
        p = (low + high) / 2
        tail = sum(math.exp(c + i * math.log(p) + (n - i) * math.log1p(-p)) for i, c in enumerate(logs)) if 0 < p < 1 else 0.0
        low, high = (p, high) if tail > 1 - confidence else (low, p)
    return high


def choose_cutoffs(counts: dict[str, dict[float, tuple[int, int]]], risk: RiskControl = RiskControl()) -> dict[str, tuple[float, bool]]:
    """Cutoff of each stratum, and whether it is certified.

    ``counts`` gives for each stratum and cutoff how many labelled texts it
    rejects, and how many of them are sound.
    """
    level = risk.delta / (2 * max(1, len(counts)))

    def holds(at: dict[float, tuple[int, int]], cutoff: float, error: float) -> bool:
        rejected, false = at.get(cutoff, (0, 0))
        return binomial_upper(false, rejected, 1 - error) <= risk.alpha

    out = {}
    for name, at in counts.items():
        best = None
        for cutoff in (risk.share, *risk.lower):
            if not holds(at, cutoff, level):
                break
            best = cutoff
        if best is None:
            best = next((c for c in risk.upper if holds(at, c, level / len(risk.upper))), None)
        out[name] = (risk.share, False) if best is None else (best, True)
    return out


SCORE_SCHEMA = "doc_id long, h long, score double, stratum string, repetitive boolean, share double"
#: Texts are taken together up to this many characters.
BATCH_CHARS = 2_000_000


def _score(risk: RiskControl, exact: bool):
    def parts(texts: list[str | None]) -> Iterator[tuple[int, int]]:
        begin = size = 0
        for i, t in enumerate(texts):
            if size and size + len(t or "") > BATCH_CHARS:
                yield begin, i
                begin, size = i, 0
            size += len(t or "") + 1
        yield begin, len(texts)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch.column(2).to_pylist()
            for begin, end in parts(every):
                texts, part = every[begin:end], batch.slice(begin, end - begin)
                scores, cjk, shares = batch_scores(texts, exact)
                # Labels are needed only where a cutoff could reject.
                labels = [exact_share(t) >= risk.share if s >= risk.floor else None for t, s in zip(texts, scores)]
                strata = [stratum_of(c, len(t or "")) for c, t in zip(cjk, texts)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(scores, pa.float64()), pa.array(strata, pa.string()), pa.array(labels, pa.bool_()), pa.nulls(len(texts), pa.float64()) if shares is None else pa.array(shares, pa.float64())], ["doc_id", "h", "score", "stratum", "repetitive", "share"])

    return score


def scored_documents(documents: DataFrame, risk: RiskControl = RiskControl(), id_col: str = "doc_id", text_col: str = "text", exact: bool = False) -> DataFrame:
    """Every row's score and stratum, and the label of those that a cutoff could reject; the one pass over the texts."""
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("h"), F.col(text_col).alias("text"))
    return materialize(docs.mapInArrow(_score(risk, exact), SCORE_SCHEMA))


def _counts(scored: DataFrame, risk: RiskControl) -> dict[str, dict[float, tuple[int, int]]]:
    """Rejected and falsely rejected distinct texts, per stratum and cutoff; as many rows as there are strata and cutoffs reach the driver."""
    texts = scored.groupBy("stratum", "h").agg(F.first("score").alias("score"), F.first("repetitive").alias("repetitive"))
    cutoffs = (risk.share, *risk.lower, *risk.upper)
    hits = [F.count_if(F.col("score") >= c).alias(f"n{i}") for i, c in enumerate(cutoffs)] + [F.count_if((F.col("score") >= c) & ~F.col("repetitive")).alias(f"f{i}") for i, c in enumerate(cutoffs)]
    rows = texts.groupBy("stratum").agg(*hits).collect()
    return {r["stratum"]: {c: (r[f"n{i}"], r[f"f{i}"]) for i, c in enumerate(cutoffs)} for r in rows}


def repetition(documents: DataFrame, risk: RiskControl = RiskControl(), id_col: str = "doc_id", text_col: str = "text", exact: bool = True) -> DataFrame:
    """``doc_id, share, score, stratum, cutoff, certified, repetitive`` of every row; ``share`` by the definition, null unless ``exact``."""
    scored = scored_documents(documents, risk, id_col, text_col, exact=exact)
    cut, sure = F.lit(risk.share), F.lit(False)
    for name, (value, certified) in choose_cutoffs(_counts(scored, risk), risk).items():
        cut = F.when(F.col("stratum") == name, F.lit(value)).otherwise(cut)
        sure = F.when(F.col("stratum") == name, F.lit(certified)).otherwise(sure)
    return scored.select("doc_id", F.round("share", 6).alias("share"), F.round("score", 6).alias("score"), "stratum", cut.alias("cutoff"), sure.alias("certified"), (F.col("score") >= cut).alias("repetitive"))


def risk_report(documents: DataFrame, risk: RiskControl = RiskControl(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``stratum, cutoff, certified, rejected, falsely_rejected, upper_bound`` on all distinct texts."""
    counts = _counts(scored_documents(documents, risk, id_col, text_col), risk)
    rows = []
    for name, (value, certified) in sorted(choose_cutoffs(counts, risk).items()):
        n, false = counts[name][value]
        rows.append((name, value, certified, n, false, binomial_upper(false, n, 1 - risk.delta)))
    return documents.sparkSession.createDataFrame(rows, "stratum string, cutoff double, certified boolean, rejected long, falsely_rejected long, upper_bound double")
