"""Near-duplicate records with small edits (problem 5).

A description is the set of its half sentences: every sentence (letters and
words only, case and width folded) is split in its middle, on both sides of
the middle word if it has one.  A substituted, inserted or deleted word or
character leaves one half of its sentence as it was, so texts with an edit in
each of their sentences still share about one element for each of them, and
order, markup, numbering and punctuation change none.  The search for pairs
that share ``SHARED`` elements a sentence, of the text with more sentences, is a
T-occurrence problem.

Elements are ordered from rare to frequent; each text goes to the lists of its
``n - T + 1`` rarest of its ``n`` elements only.  In a list, pairs whose wording
can't agree are left out first: amounts too far apart (length filter), or
sketches of the wording that differ in more bits than a near-duplicate's can
(exact: no pair that agrees is lost).  The overlap of the few left is counted;
where they are many, DivideSkip answers the T-occurrence queries: the long
inverted lists are put aside, the short ones heap-merged, and their candidates
looked up in the long ones by binary search.  A pair is reported in the list of
its rarest common element alone and then always judged on the wording of its own
title, company and description.

The nodes are the distinct texts (title, company and description together, by a
128-bit digest), so copies under many ids are searched once, and an id with
several texts keeps them all.  A list of more than ``BLOCK`` texts is spread over
pairs of blocks, so no element, however frequent, makes an unbounded task.

Null or blank descriptions take no part; a description without letters is one
element; repeated rows of one id count once; null titles and companies are
empty.  What the search can miss: pairs most of whose sentences carry edits in
both halves.
"""

from __future__ import annotations

import heapq
import math
import re
from array import array
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from operator import add

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.llm.textforms import simplify
from millrace.session import broadcast_within, materialize

#: Elements that a pair has in common for each sentence at least, and the agreement in wording (Jaccard over words and character pairs) that makes it a near-duplicate.
SHARED, AGREEMENT = 0.9, 0.62
BLOCK = 2000
#: So many such lists are broadcast.
HOT = 100_000
#: Members of a class of copies that one task pairs with another such part.
PART = 2000

_TAGS = re.compile(r"<[^<>]*>")
_CJK = "぀-ヿ㐀-鿿"
_ENDS = frozenset(".。;；!！?？\n\r•:：…")
_WORDS = re.compile(rf"[{_CJK}]+|[^\W\d_{_CJK}]+")
_PIECES = re.compile(rf"[{_CJK}]+|[^\W\d_{_CJK}]+|[.。;；!！?？\n\r•:：…]")
#: Shorter sentences are one element.
SHORT = 4


#: Bits of a sketch, kept as four columns.
SKETCH = 256
_MARKS = [f"s{i}" for i in range(SKETCH // 64)]
#: Items that are sketched at once.
ITEMS = 1 << 20


class _Kinds(dict):
    """16 bits of the hash of each item; a bounded number of them is remembered."""

    def __missing__(self, item: str) -> int:
        kind = xxhash.xxh32_intdigest(item) & 0xFFFF
        if len(self) < 1 << 17:
            self[item] = kind
        return kind


_KINDS = _Kinds()


def _kinds(items: Iterable[str]) -> bytes:
    return array("H", map(_KINDS.__getitem__, items)).tobytes()


def sketches(kinds: list[bytes]) -> np.ndarray:
    """Bit by bit the parity of how many items of a wording fall on it, from the kinds of the items of each text.

    What occurs again counts as another item, so every bit in which two sketches differ takes an item that only one of the wordings has.
    """
    sizes = np.array([len(x) // 2 for x in kinds], np.int64)
    if len(kinds) > 1 and sizes.sum() > ITEMS:
        half = len(kinds) // 2
        return np.concatenate([sketches(kinds[:half]), sketches(kinds[half:])])
    of = np.repeat(np.arange(len(kinds)) << 16, sizes)
    key = np.sort(of + np.frombuffer(b"".join(kinds), np.uint16))
    place = np.arange(len(key))
    again = place - np.maximum.accumulate(np.where(np.diff(key, prepend=-1) != 0, place, 0))
    with np.errstate(over="ignore"):
        bit = ((key & 0xFFFF).astype(np.uint64) + (again.astype(np.uint64) << np.uint64(16)) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)
    odd = np.bincount((key >> 16) * SKETCH + (bit % np.uint64(SKETCH)).astype(np.int64), minlength=len(kinds) * SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).reshape(-1, len(_MARKS))


def _element(side: str, units: list[str]) -> int:
    return (xxhash.xxh32_intdigest(f"{side}{' '.join(units)}")) - (1 << 31)


def _east(word: str) -> bool:
    return "\u3040" <= word[0] <= "\u30ff" or "\u3400" <= word[0] <= "\u9fff"


def elements(description: str) -> tuple[set[int], int, bytes]:
    """Hashes of the half sentences of a description, how many a near-duplicate has in common with it at least, and the kinds of the items of its wording.

    A text without letters is one element.  The hashes only steer the search;
    pairs are judged on their texts.
    """
    out, heads, tails = set(), set(), set()
    units: list[str] = []
    items: list[str] = []
    for piece in (*_PIECES.findall(simplify(_TAGS.sub("\n", description))), "."):
        if piece not in _ENDS:
            if piece >= "\u3040" and _east(piece):
                units += piece
                if len(piece) > 1:
                    items += map(add, piece, piece[1:])
                    continue
            else:
                units.append(piece)
            items.append(piece)
            continue
        n = len(units)
        if n >= SHORT:
            k = n // 2
            out.add(head := _element("<", units[:k]))
            out.add(tail := _element(">", units[n - k :]))
            heads.add(head)
            tails.add(tail)
            if n % 2:
                out.add(_element("<", units[: k + 1]))
                out.add(_element(">", units[k:]))
        elif n:
            out.add(_element("=", units))
        units = []
    # Sentences that begin or end alike have a half in common with each other.
    return out or {_element("=", [description.strip()])}, max(1, math.ceil(SHARED * min(len(heads), len(tails)))), _kinds(items)


def _pieces(text: str | None) -> list[str]:
    return _WORDS.findall(simplify(_TAGS.sub(" ", text))) if text else []


def wording(title: str | None, company: str | None, description: str | None) -> frozenset:
    """Words, and of Chinese and Japanese text character pairs; what occurs again is told apart by its count."""
    found: list = []
    for text in (title, company, description):
        for word in _pieces(text):
            if not _east(word) or len(word) == 1:
                found.append(word)
            else:
                found += zip(word, word[1:])
    once = frozenset(found)
    if len(once) == len(found):
        return once
    seen: Counter = Counter()
    counted = []
    for x in found:
        seen[x] += 1
        counted.append(x if seen[x] == 1 else (x, seen[x]))
    return frozenset(counted)


def agreement(a: frozenset, b: frozenset) -> float:
    """Jaccard over counted words; two records without any letters agree wholly."""
    common = len(a & b)
    whole = len(a) + len(b) - common
    return common / whole if whole else 1.0


def divide_skip(query: Sequence[int], lists: dict[int, list[int]], least: int, long_lists: int | None = None) -> dict[int, int]:
    """Positions that occur in at least ``least`` of the query's inverted lists, with their counts.

    ``lists`` holds sorted positions.  The ``long_lists`` longest are only
    probed; at most ``least - 1`` may be, or a result could be missed.
    """
    found = sorted((lists[t] for t in query if lists.get(t)), key=len, reverse=True)
    if len(found) < least:
        return {}
    if long_lists is None:
        long_lists = int(least / (0.01 * max(map(len, found)) ** 0.5 + 1))
    long_lists = max(0, min(long_lists, least - 1))
    long, short = found[:long_lists], found[long_lists:]
    out: dict[int, int] = {}
    heap = [(x[0], i, 0) for i, x in enumerate(short)]
    heapq.heapify(heap)
    while heap:
        at, n = heap[0][0], 0
        while heap and heap[0][0] == at:
            _, i, k = heap[0]
            n += 1
            if k + 1 < len(short[i]):
                heapq.heapreplace(heap, (short[i][k + 1], i, k + 1))
            else:
                heapq.heappop(heap)
        if n + long_lists >= least:
            for x in long:
                k = bisect_left(x, at)
                n += k < len(x) and x[k] == at
            if n >= least:
                out[at] = n
    return out


#: Key, least overlap, amount of wording, block, and the shared elements from rare to frequent: those before the list's own, and from it on.
Member = tuple[int, int, int, int, list[int], list[int]]
#: More pairs a member than this are left to the T-occurrence search.
FEW = 64


def _reported(one: Member, two: Member) -> bool:
    """Whether the amounts of wording can agree and the list has the pair's rarest common element."""
    return one[0] != two[0] and min(one[2], two[2]) >= AGREEMENT * max(one[2], two[2]) and set(one[4]).isdisjoint(two[4])


def search_list(members: list[Member], left: int, right: int) -> Iterator[tuple[int, int]]:
    """Pairs of one list that share enough elements and have its element as their rarest common one.

    Only pairs between block ``left`` and block ``right``.
    """

    lists: dict[int, list[int]] = {}
    for j, m in enumerate(members):
        if m[3] == right:
            for t in m[5]:
                lists.setdefault(t, []).append(j)
    for i, one in enumerate(members):
        least = one[1]
        if one[3] != left or len(one[5]) < least:
            continue
        for j, common in divide_skip(one[5], lists, least).items():
            most = members[j][1]
            # Within a block both ends ask; the one that needs more, or else the first, reports.
            if common >= most and (left != right or most < least or (most == least and j > i)) and _reported(one, members[j]):
                yield min(one[0], members[j][0]), max(one[0], members[j][0])


def _may_agree(size: np.ndarray, sizes: np.ndarray, differing: np.ndarray) -> np.ndarray:
    """Whether wordings of these sizes, at least ``differing`` items of which are only in one of them, can agree."""
    whole = size + sizes
    return (np.minimum(size, sizes) >= AGREEMENT * np.maximum(size, sizes)) & (whole - differing >= AGREEMENT * (whole + differing) - 1e-6)


#: Pairs of short lists that are compared at once, and the length of the lists that are compared a member at a time.
AT_ONCE, LONG = 1 << 19, 128


def close_pairs(begin: np.ndarray, end: np.ndarray, words: np.ndarray, marks: np.ndarray, apart: np.ndarray, block: np.ndarray) -> Iterator[tuple[int, list[tuple[int, int]] | None]]:
    """Of each list of rows ``begin`` to ``end``, in order of ``words``, those pairs whose wording may agree; None if they are too many.

    Where ``apart``, only pairs of different blocks.
    """

    def few(lists: np.ndarray) -> Iterator[tuple[int, list[tuple[int, int]]]]:
        n = end[lists] - begin[lists]
        at, row = np.repeat(lists, n), np.repeat(begin[lists], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        later = end[at] - row - 1
        i, at = np.repeat(row, later), np.repeat(at, later)
        j = i + 1 + np.arange(later.sum()) - np.repeat(np.cumsum(later) - later, later)
        keep = _may_agree(words[i], words[j], 0) & ~(apart[at] & (block[i] == block[j]))
        i, j, at = i[keep], j[keep], at[keep]
        keep = _may_agree(words[i], words[j], np.bitwise_count(marks[i] ^ marks[j]).sum(1, np.int64))
        found: dict[int, list[tuple[int, int]]] = {}
        for k, x, y in zip(at[keep].tolist(), i[keep].tolist(), j[keep].tolist()):
            found.setdefault(k, []).append((x, y))
        for k, pairs in found.items():
            yield k, pairs if len(pairs) <= FEW * (end[k] - begin[k]) else None

    def many(k: int) -> list[tuple[int, int]] | None:
        pairs: list[tuple[int, int]] = []
        last = begin[k] + np.searchsorted(words[begin[k] : end[k]], words[begin[k] : end[k]] / AGREEMENT + 1e-6, "right")
        for i, stop in zip(range(begin[k], end[k]), last.tolist()):
            keep = _may_agree(words[i], words[i + 1 : stop], np.bitwise_count(marks[i] ^ marks[i + 1 : stop]).sum(1, np.int64))
            if apart[k]:
                keep &= block[i] != block[i + 1 : stop]
            pairs += [(i, j) for j in (np.flatnonzero(keep) + i + 1).tolist()]
            if len(pairs) > FEW * (end[k] - begin[k]):
                return None
        return pairs

    n = end - begin
    short = np.flatnonzero((n > 1) & (n <= LONG))
    for part in np.split(short, np.flatnonzero(np.diff(np.cumsum(n[short] ** 2) // AT_ONCE)) + 1) if len(short) else []:
        yield from few(part)
    for k in np.flatnonzero(n > LONG).tolist():
        yield k, many(k)


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists arrive together, as the rows are sorted; the rows of one are held at a time."""

    def pairs_of(rows: pa.Table) -> Iterator[tuple[int, int]]:
        tok, left, right, key, least, words, block = (rows.column(c).to_numpy() for c in ("tok", "left", "right", "t", "least", "words", "block"))
        marks = np.stack([rows.column(c).to_numpy() for c in _MARKS], 1).view(np.uint64)
        toks = rows.column("toks").combine_chunks()
        ends, flat = toks.offsets.to_numpy(), toks.values.to_numpy()
        sizes = words.astype(np.int64)
        new = np.flatnonzero((np.diff(tok) != 0) | (np.diff(left) != 0) | (np.diff(right) != 0)) + 1
        edges = np.concatenate([[0], new, [len(tok)]])

        def member(i: int) -> Member:
            have = flat[ends[i] : ends[i + 1]].tolist()
            at = have.index(tok[i])
            return int(key[i]), int(least[i]), int(words[i]), int(block[i]), have[:at], have[at:]

        for k, pairs in close_pairs(edges[:-1], edges[1:], sizes, marks, (left != right)[edges[:-1]], block):
            if pairs is None:
                rows_of = {int(key[i]): i for i in range(edges[k], edges[k + 1])}
                for a, b in search_list([member(i) for i in rows_of.values()], int(left[edges[k]]), int(right[edges[k]])):
                    i, j = rows_of[a], rows_of[b]
                    if _may_agree(sizes[i], sizes[j], int(np.bitwise_count(marks[i] ^ marks[j]).sum())):
                        yield a, b
                continue
            known = {i: member(i) for i in {i for pair in pairs for i in pair}}
            for one, two in ((known[i], known[j]) for i, j in pairs):
                if len(set(one[5]).intersection(two[5])) >= max(one[1], two[1]) and _reported(one, two):
                    yield min(one[0], two[0]), max(one[0], two[0])

    def out(rows: pa.Table) -> pa.RecordBatch:
        pairs = list(pairs_of(rows)) if rows.num_rows else []
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in pairs], pa.int64()), pa.array([x[1] for x in pairs], pa.int64())], ["a", "b"])

    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        held = pa.concat_tables([held, rows]) if held is not None else rows
        last = held.slice(held.num_rows - 1, 1)
        same = np.ones(held.num_rows, bool)
        for c in ("tok", "left", "right"):
            same &= held.column(c).to_numpy() == last.column(c)[0].as_py()
        begin = int(np.argmax(same))
        if begin:
            yield out(held.slice(0, begin))
            held = held.slice(begin)
    if held is not None:
        yield out(held)


def _element_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    @lru_cache(maxsize=4096)
    def cut(title, company, description):
        found, least, kinds = elements(description)
        return sorted(found), least, kinds + named(title) + named(company)

    @lru_cache(maxsize=4096)
    def named(text):
        return _kinds(x for w in _pieces(text) for x in (map(add, w, w[1:]) if len(w) > 1 and _east(w) else (w,)))

    for batch in batches:
        found = [cut(*x) for x in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)))]
        marks = sketches([x[2] for x in found])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x[0] for x in found], pa.list_(pa.int32())), pa.array([x[1] for x in found], pa.int32()), pa.array([len(x[2]) // 2 for x in found], pa.int32()), *(pa.array(x, pa.int64()) for x in marks.T)], ["id", "d", "toks", "least", "words", *_MARKS])


def _described(jobs: DataFrame) -> DataFrame:
    """``id, d, title, company, description``, ``d`` a digest of the three texts."""
    part = lambda c: F.concat(F.length(F.coalesce(c, F.lit(""))).cast("string"), F.lit(":"), F.coalesce(c, F.lit("")))
    digest = F.unhex(F.md5(F.concat(*[part(F.col(c)) for c in ("title", "company", "description")])))
    return jobs.filter(F.col("id").isNotNull() & F.col("description").rlike(r"[^\s\u3000]")).select("id", digest.alias("d"), "title", "company", "description")


def near_duplicate_links(jobs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links between distinct texts (``a, b``), and ``id, t``: the texts of every id."""
    described, carried = _described(jobs), ("least", "words", *_MARKS)
    rows = materialize(described.mapInArrow(_element_rows, "id string, d binary, toks array<int>, least int, words int, " + ", ".join(f"{x} long" for x in _MARKS)))
    # The keys are drawn once and written; a lost executor reads them again.
    heads = materialize(rows.groupBy("d").agg(*(F.first(x).alias(x) for x in ("toks", *carried))).withColumn("t", F.monotonically_increasing_id()))
    member = materialize(rows.select("id", "d").distinct().join(heads.select("d", "t"), "d").select("id", "t"))
    postings = heads.select("t", F.explode("toks").alias("tok"))
    frequent = heads.select(F.explode("toks").alias("tok")).groupBy("tok").agg(F.count("*").cast("int").alias("df")).filter("df > 1")
    # Elements that no other text has can't be common.
    shared = postings.join(frequent, "tok").groupBy("t").agg(F.array_sort(F.collect_list(F.struct("df", "tok"))).alias("o"))
    # What a text needs comes back once a text, not with each of its elements.
    prefix = F.slice("o", F.lit(1), F.size("o") - F.col("least") + 1)
    ordered = materialize(shared.join(heads.select("t", *carried), "t").filter(F.size("o") >= F.col("least")).select("t", *carried, F.transform("o", lambda x: x["tok"]).alias("toks"), prefix.alias("p")))
    # Blocks are as many as a list needs, which most texts with its element aren't in.
    hot = materialize(ordered.select(F.explode("p").alias("p")).filter(F.col("p.df") > BLOCK).groupBy(F.col("p.tok").alias("tok")).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")).filter("blocks > 1"))
    routed = ordered.select("t", *carried, "toks", F.explode("p.tok").alias("tok")).join(broadcast_within(hot, HOT), "tok", "left")
    blocks = F.coalesce("blocks", F.lit(1))
    own = F.pmod(F.xxhash64("t"), blocks).cast("int")
    spread = routed.withColumn("block", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    lists = spread.select("tok", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"), "t", *carried, "toks", "block")
    found = lists.repartition("tok", "left", "right").sortWithinPartitions("tok", "left", "right", "words").mapInArrow(_search, "a long, b long")
    candidates = materialize(found.distinct())
    wanted = candidates.select(F.explode(F.array("a", "b")).alias("t")).distinct().join(heads.select("d", "t"), "t")
    texts = materialize(described.drop("id").join(wanted, "d").dropDuplicates(["t"]).select("t", F.struct("title", "company", "description").alias("x")))

    @F.pandas_udf("boolean")
    def agree(t1: pd.Series, c1: pd.Series, d1: pd.Series, t2: pd.Series, c2: pd.Series, d2: pd.Series) -> pd.Series:
        counted = lru_cache(maxsize=4096)(wording)
        return pd.Series([agreement(counted(*x), counted(*y)) >= AGREEMENT for x, y in zip(zip(t1, c1, d1), zip(t2, c2, d2))], dtype=bool)

    one, two = (texts.select(F.col("t").alias(k), F.col("x").alias(x)) for k, x in (("a", "x"), ("b", "y")))
    links = candidates.join(one, "a").join(two, "b").filter(agree("x.title", "x.company", "x.description", "y.title", "y.company", "y.description")).select("a", "b")
    return materialize(links), member


def _parts(member: DataFrame) -> DataFrame:
    """``member`` with the number of parts its text's ids are cut into, and its own part."""
    size = member.groupBy("t").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    return materialize(member.join(size, "t").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")))


def near_duplicate_pairs(jobs: DataFrame) -> DataFrame:
    """``id_a, id_b``, the smaller first: every pair of near-duplicate ids once.

    The ids of a text with very many copies are paired part by part.
    """
    links, member = near_duplicate_links(jobs)
    placed = _parts(member)
    size = placed.groupBy("t").agg(F.count("*").alias("n"), F.max("parts").alias("parts"))
    equal = size.filter("n > 1").select(F.col("t").alias("a"), F.col("t").alias("b"))
    both = links.unionByName(equal).join(size.select(F.col("t").alias("a"), F.col("parts").alias("pa")), "a").join(size.select(F.col("t").alias("b"), F.col("parts").alias("pb")), "b")
    tasks = both.select("a", "b", F.explode(F.sequence(F.lit(0), F.col("pa") - 1)).alias("i"), "pb").select("a", "b", "i", F.explode(F.sequence(F.lit(0), F.col("pb") - 1)).alias("j"))
    x, y = placed.select(F.col("t").alias("a"), F.col("part").alias("i"), F.col("id").alias("id_x")), placed.select(F.col("t").alias("b"), F.col("part").alias("j"), F.col("id").alias("id_y"))
    named = tasks.join(x, ["a", "i"]).join(y, ["b", "j"]).filter("id_x <> id_y")
    return named.select(F.least("id_x", "id_y").alias("id_a"), F.greatest("id_x", "id_y").alias("id_b")).distinct()


def near_duplicate_groups(jobs: DataFrame) -> DataFrame:
    """``id, class_id, links``: one row per id with a description; a record without near-duplicates is its own class.

    Texts of one id are one class; ``links`` counts the other texts its texts are linked to.
    """
    links, member = near_duplicate_links(jobs)
    same_id = member.groupBy("id").agg(F.min("t").alias("a")).join(member, "id").filter("a <> t").select("a", F.col("t").alias("b"))
    labels = components(links.unionByName(same_id).distinct())
    degree = links.select(F.explode(F.array("a", "b")).alias("t")).groupBy("t").agg(F.count("*").alias("links"))
    full = member.join(labels.select(F.col("node").alias("t"), "component"), "t", "left").join(degree, "t", "left")
    return full.groupBy("id").agg(F.min(F.coalesce("component", "t")).alias("class_id"), F.coalesce(F.sum("links"), F.lit(0)).alias("links"))
