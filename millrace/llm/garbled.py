"""Garbled text from a wrong character encoding (problem 7).

A best-first graph search: states are texts, moves re-encode a text with one
codec and decode it with another or undo an escape, a plausibility cost of the
characters guides the search to the cheapest reachable text, and visited
states are kept by hash.  The search runs on the stretches of a text that look
foreign, so a single garbled passage in a sound text is found and restored.
Latin words with East Asian letters in them are searched word by word.

A text that holds escapes (entities, per cent or ``\\u`` sequences), ASCII or
not, is searched as it stands when they are undone as well; escapes alone
aren't garbling and are left.

A stretch is garbled if a path with at least one codec move makes it much
cheaper; replacement characters and their re-decoded remains are garbled
beyond repair.  Null, empty and sound texts are not found and stay as they
are.  Texts are judged whole, whatever their length; the search of one stretch
ends after ``EXPANSIONS`` states and ``DEPTH`` moves, cheapest states first, so
text garbled more than ``DEPTH`` times over is reported as far as a shorter path
makes it cheaper.
"""

from __future__ import annotations

import bisect
import codecs
import functools
import heapq
import html
import re
from collections.abc import Iterator
from urllib.parse import unquote

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Codecs a text may have been read in by mistake, and those it was written in.
SINGLE = ("cp1252", "latin-1", "mac_roman", "cp1251", "koi8_r", "cp437", "cp850", "cp1250", "cp866", "iso8859_2")
MULTI = ("gbk", "big5", "cp932", "euc_kr", "euc_jp")
WRITTEN = ("utf-8", "gbk", "big5", "cp932")
LOST = re.compile("�|锟斤|斤拷|拷锟|ï¿½|烫烫|屯屯")
#: A state this cheap per character is sound and isn't taken apart further.
SOUND = 1.35
#: A restored stretch must cost at most this share of the garbled one.
GAIN = 0.62


@functools.cache
def _costs() -> np.ndarray:
    """Cost of each BMP character: what sound text is made of costs 1."""
    out = np.full(0x10000, 5.0, np.float32)
    out[0x20:0x7F] = 1
    out[[9, 10, 13]] = 1
    out[0:9] = 10
    out[0x80:0xA0] = 10
    out[0xA0:0xC0] = 3
    out[0xC0:0x180] = 2.2
    out[[0xD7, 0xF7]] = 2
    out[0x2010:0x2028] = 1.2
    out[0x20AC] = out[0x2122] = out[0x2022] = 1.6
    out[0x400:0x460] = 1.6
    out[0x2500:0x25A0] = 8
    out[0x3000:0x3018] = 1
    out[0x3040:0x3100] = 1.3
    out[0x3400:0xA000] = 6
    out[0xAC00:0xD7A4] = 4
    out[0xE000:0xF900] = 12
    out[0xFF01:0xFF5F] = 1.2
    out[0xFF61:0xFFA0] = 7
    out[0xFFFD] = 12
    for lead in range(0xB0, 0xF8):
        for trail in range(0xA1, 0xFF):
            try:
                out[ord(bytes((lead, trail)).decode("gb2312"))] = 1.0 if lead < 0xD8 else 3.5
            except UnicodeDecodeError:
                pass
    for lead in range(0x88, 0x98):
        for trail in range(0x40, 0xFD):
            try:
                cp = ord(bytes((lead, trail)).decode("cp932"))
            except (UnicodeDecodeError, TypeError):
                continue
            out[cp] = min(out[cp], 2.0)
    return out


@functools.lru_cache(maxsize=0x10000)
def _cost_of(char: str) -> float:
    return float(_costs()[min(ord(char), 0xFFFF)])


def cost(text: str) -> float:
    cps = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    return float(_costs()[np.minimum(cps, 0xFFFF)].sum())


_SLOPPY = {c: bytes([c]) for c in range(0x80, 0xA0)}


def _encode(text: str, codec: str) -> bytes | None:
    try:
        return text.encode(codec)
    except UnicodeEncodeError:
        if codec not in SINGLE:
            return None
    out = []
    for ch in text:
        try:
            out.append(ch.encode(codec))
        except UnicodeEncodeError:
            if ord(ch) not in _SLOPPY:
                return None
            out.append(_SLOPPY[ord(ch)])
    return b"".join(out)


def _decode(data: bytes, codec: str) -> str | None:
    """Strictly, but for a character cut off at either end of a longer stretch."""
    if codec == "utf-8":
        if len(data) >= 9:
            data = data[next((i for i, b in enumerate(data[:4]) if not 0x80 <= b < 0xC0), 0) :]
            for back in range(1, 4):
                lead = data[-back]
                if lead >= 0xC0:
                    data = data[:-back] if back < 2 + (lead >= 0xE0) + (lead >= 0xF0) else data
                    break
                if lead < 0x80:
                    break
    for tried in (data, data[:-1]) if codec != "utf-8" and len(data) >= 9 else (data,):
        try:
            return tried.decode(codec)
        except UnicodeDecodeError:
            pass
    return None


def moves(text: str) -> Iterator[tuple[str, bool]]:
    """Texts one move away; whether the move changes the codec."""
    for codec in (*SINGLE, *MULTI):
        data = _encode(text, codec)
        if data is None or data.isascii():
            continue
        for target in WRITTEN:
            if target == codec or (codec in SINGLE and target != "utf-8" and (len(data) < 4 or codec not in ("cp1252", "latin-1"))):
                continue
            if codec in MULTI and target != "utf-8" and len(text) < 6:
                continue
            got = _decode(data, target)
            if got and got != text and not got.isascii():
                yield got, True
                if target == "utf-8" and codec in SINGLE:
                    break  # what is valid UTF-8 byte for byte is nothing else
    if "&" in text and (got := html.unescape(text)) != text:
        yield got, False
    if "%" in text and (got := unquote(text, errors="strict") if re.search("(?:%[0-9A-Fa-f]{2}){2}", text) else text) != text:
        yield got, False
    if "\\u" in text and (got := re.sub(r"\\u([0-9a-fA-F]{4})", lambda m: chr(int(m[1], 16)), text)) != text:
        yield got, False


#: Bounds of the search of one stretch.
EXPANSIONS, DEPTH = 24, 3


def search(text: str, expansions: int = EXPANSIONS, depth: int = DEPTH) -> tuple[str, bool]:
    """Cheapest reachable text, and whether a codec move leads there."""
    start = cost(text)
    best, best_cost, best_codec = text, start, False
    heap, seen = [(start, 0, text, False)], {hash(text)}
    while heap and expansions:
        expansions -= 1
        _, level, state, by_codec = heapq.heappop(heap)
        if level == depth or (level and cost(state) <= SOUND * len(state)):
            continue
        try:
            around = list(moves(state))
        except ValueError:
            continue
        for nxt, codec in around:
            if hash(nxt) in seen:
                continue
            seen.add(hash(nxt))
            c = cost(nxt)
            if c < best_cost and (by_codec or codec):
                best, best_cost, best_codec = nxt, c, True
            if c < 1.2 * start:
                heapq.heappush(heap, (c, level + 1, nxt, by_codec or codec))
    return (best, best_codec) if best_cost <= GAIN * start else (text, False)


_FOREIGN = r"\x80-ʯˆ-˝Ͱ-ӿ‐-‧‰-›€№™Ω∀-⋿⌠-⌡─-◊ﬁﬂ"
_STRETCH = re.compile(f"[{_FOREIGN}]{{2,}}(?: ?[{_FOREIGN}]{{2,}})*")
_HAN_STRETCH = re.compile(r"[^\x00-\x7f�]{2,}")


@functools.cache
def _rare_han() -> re.Pattern:
    costs = _costs()
    rare = [cp for cp in range(0x3400, 0xA000) if costs[cp] > 1] + list(range(0xE000, 0xF900)) + list(range(0xFF61, 0xFFA0)) + list(range(0xAC00, 0xD7A4))
    out, i = [], 0
    while i < len(rare):
        j = i
        while j + 1 < len(rare) and rare[j + 1] == rare[j] + 1:
            j += 1
        out.append(f"{chr(rare[i])}-{chr(rare[j])}")
        i = j + 1
    return re.compile(f"[{''.join(out)}]")


_CJK = "ᄀ-ᇿ⺀-⿿々-〇〡-鿿가-힣-﫿ｦ-ﾟ"
_MIXED = re.compile(f"[A-Za-z][{_CJK}]|[{_CJK}][A-Za-z]")
_EAST = re.compile(f"[{_CJK}]")
#: Words of a Latin text: blanks and the ASCII signs that no multi-byte codec takes for a second byte end them.
_WORD = re.compile(r"[^\x00-&(-,./:-?]+")
_ACCENTED = re.compile("[À-ÖØ-öø-þĀ-ɏḀ-ỿ]")
_CLAUSE_END = re.compile("[\n。！？；<>]")
#: What an East Asian letter costs for each Latin letter and each blank or sign beside it, and the least gain that tells.
MIX, ALONE, TELLING = 3.0, 1.5, 3.0


def _utf8(text: str, codec: str) -> str | None:
    data = _encode(text, codec)
    try:
        return data.decode("utf-8") if data else None
    except UnicodeDecodeError:
        return None


def _latin(text: str) -> bool:
    return not (re.search("[Ͱ-᷿]", text) or _EAST.search(text) or any(cost(c) > 3 for c in text))


def _latin_gain(word: str, got: str) -> tuple[float, bool, bool] | None:
    """How much cheaper ``word`` gets as the Latin text ``got``, and whether an accented letter stands in a word or at its end; None if it isn't Latin."""
    if not _latin(got):
        return None
    gain, inside, edge = cost(word) - cost(got), False, False
    for m in _ACCENTED.finditer(got):
        i = m.start()
        sides = [got[i - 1 : i] if i else "", got[i + 1 : i + 2]]
        letters = [c for c in sides if c.isalpha()]
        before, after = sides
        if letters and (before.isalpha() and not before.isupper() if m[0].isupper() else after.isupper() or not any(c.islower() for c in letters)):
            return None
        if letters:
            gain += sum(MIX if c.isalpha() else ALONE for c in sides)
        inside |= len(letters) == 2
        edge |= len(letters) == 1 and bool(re.search("[A-Za-z]{2}$", got[:i]) or re.match("[A-Za-z]{2}", got[i + 1 :]))
    return gain, inside, edge


def _latin_words(text: str, codec: str) -> Iterator[tuple[int, int, str | None, bool]]:
    """``begin, end, decoded, beside``: words with foreign letters, in pieces if they don't decode as a whole; whether sound text touches them."""
    for m in _WORD.finditer(text):
        word = m.group()
        if word.isascii():
            continue
        if (got := _utf8(word, codec)) and _latin(got):
            yield m.start(), m.end(), got, False
            continue
        i = 0
        ok = [c.isascii() or ((x := _utf8(c, codec)) is not None and _latin(x)) for c in word]
        while i < len(word):
            j = i
            while j < len(word) and ok[j] == ok[i]:
                j += 1
            if not ok[i] or not word[i:j].isascii():
                beside = bool(i and _EAST.match(word[i - 1])) or bool(j < len(word) and _EAST.match(word[j]))
                yield m.start() + i, m.start() + j, _utf8(word[i:j], codec) if ok[i] else None, beside
            i = j


def fix_latin(text: str) -> tuple[str, bool]:
    """Latin text in UTF-8 that was read in a multi-byte codec ('f眉r' for 'für'), restored passage by passage.

    A passage is a longest sequence of words that are ASCII or decode.  It is
    judged by its cost, where a letter of another script costs the more the
    closer it stands to Latin ones; a letter at the end of a word tells only
    if its clause holds no letter that doesn't decode, and
    a word that touches sound East Asian text only together with another.
    """
    best, best_gain = text, 0.0
    ends = [m.start() for m in _CLAUSE_END.finditer(text)]
    for codec in MULTI:
        passages: list[list[tuple[int, int, str, float, bool, bool, bool]]] = [[]]
        sound: list[int] = []
        for begin, end, got, beside in _latin_words(text, codec):
            judged = _latin_gain(text[begin:end], got) if got else None
            if judged:
                gain, inside, edge = judged
                passages[-1].append((begin, end, got, gain, inside, edge, beside))
            else:
                passages.append([])
                if any(cost(c) <= 4 for c in _EAST.findall(text, begin, end)):
                    sound.append(begin)
        out, at, total = [], 0, 0.0
        for passage in passages:
            several = sum(inside for *_, inside, _, _ in passage) > 1
            for begin, end, _, gain, inside, edge, beside in passage:
                if gain < TELLING or not (inside or edge) or (beside and not several):
                    continue
                clause = bisect.bisect(ends, begin)
                k = bisect.bisect(sound, ends[clause - 1]) if clause else 0
                if inside or k == len(sound) or (clause < len(ends) and sound[k] > ends[clause]):
                    break
            else:
                continue
            for begin, end, got, gain, *_ in passage:
                out += [text[at:begin], got]
                at, total = end, total + gain
        if total > best_gain:
            best, best_gain = "".join(out) + text[at:], total
    return best, best_gain > 0


def _chains(encoded: list[bytes | None], costs: list[float], target: str) -> Iterator[tuple[int, int]]:
    """Longest stretches of a run of characters that ``target`` decodes, without the ends that decoding makes dearer."""
    begin = 0
    while begin < len(encoded):
        if encoded[begin] is None or (target == "utf-8" and not 0xC2 <= encoded[begin][0] <= 0xF4):
            begin += 1
            continue
        # Links end where a character of both codecs does.
        links: list[tuple[int, int, float]] = []
        at, since = begin, begin
        decoder = codecs.getincrementaldecoder(target)()
        out = ""
        while at < len(encoded) and encoded[at] is not None:
            try:
                out += decoder.decode(encoded[at])
            except UnicodeDecodeError:
                break
            at += 1
            if not decoder.getstate()[0]:
                links.append((since, at, sum(costs[since:at]) - sum(_cost_of(c) for c in out)))
                since, out = at, ""
        reached = since
        while links and links[0][2] <= 0:
            links.pop(0)
        while links and links[-1][2] <= 0:
            links.pop()
        if links:
            yield links[0][0], links[-1][1]
        begin = max(reached, begin + 1)


def fix_run(run: str) -> tuple[str, bool]:
    """A run of foreign characters restored as a whole, or in the passages of it that decode."""
    if not _rare_han().search(run):
        return run, False
    whole, changed = search(run)
    found: list[tuple[float, int, int, str]] = []
    costs = [_cost_of(c) for c in run]
    for codec in MULTI:
        encoded = [_encode(c, codec) for c in run]
        for target in WRITTEN:
            if target == codec:
                continue
            for begin, end in _chains(encoded, costs, target):
                part = run[begin:end]
                if len(part) < (3 if target == "utf-8" else 6) or part == run or not _rare_han().search(part):
                    continue
                got, better = search(part)
                if better:
                    found.append((cost(got) - cost(part), begin, end, got))
    taken: list[tuple[int, int, str]] = []
    for _, begin, end, got in sorted(found):
        if all(end <= b or begin >= e for b, e, _ in taken):
            taken.append((begin, end, got))
    out, at = [], 0
    for begin, end, got in sorted(taken):
        out += [run[at:begin], got]
        at = end
    parts = "".join(out) + run[at:]
    return (parts, True) if taken and (not changed or cost(parts) < cost(whole)) else (whole, changed)


_EASTERN = re.compile("[Ͱ-ӿ]")
_ACCENTS = re.compile("[À-ÖØ-öø-ɏ]+")


def _between_latin(stretch: str, beside: str) -> str | None:
    """A Greek or Cyrillic stretch that touches Latin letters and is UTF-8 of accented ones."""
    if not (_EASTERN.search(stretch) and any(c.isascii() and c.isalpha() for c in beside)):
        return None
    read = (_utf8(stretch, codec) for codec in SINGLE)
    return next((x for x in read if x and _ACCENTS.fullmatch(x)), None)


def _examine(text: str) -> tuple[bool, str]:
    if text.isascii():
        return False, text
    garbled = bool(LOST.search(text))

    def fix(m: re.Match) -> str:
        nonlocal garbled
        got, changed = search(m.group())
        if not changed and (latin := _between_latin(m.group(), text[max(0, m.start() - 1) : m.start()] + text[m.end() : m.end() + 1])):
            got, changed = latin, True
        garbled |= changed
        return got

    out = _STRETCH.sub(fix, text) if _STRETCH.search(text) else text
    if _MIXED.search(out):
        out, changed = fix_latin(out)
        garbled |= changed
    if len(_rare_han().findall(out)) >= 1:

        def fix_han(m: re.Match) -> str:
            nonlocal garbled
            got, changed = fix_run(m.group())
            garbled |= changed
            return got

        before, out = out, _HAN_STRETCH.sub(fix_han, out)
        if out != before and _MIXED.search(out):
            out, changed = fix_latin(out)
            garbled |= changed
    return garbled, out


_ESCAPE = re.compile(r"&(?:#\d{2,7}|#[xX][0-9A-Fa-f]{2,6}|[A-Za-z][A-Za-z0-9]{1,30});|(?:%[0-9A-Fa-f]{2}){2,}|\\u[0-9a-fA-F]{4}")
#: The same for the JVM, which sends only candidates to Python.
CANDIDATE = r"[^\x00-\x7f]|&(?:#\d{2,7}|#[xX][0-9A-Fa-f]{2,6}|[A-Za-z][A-Za-z0-9]{1,30});|(?:%[0-9A-Fa-f]{2}){2,}|\\u[0-9a-fA-F]{4}"


def _undo(m: re.Match) -> str:
    escape = m.group()
    if escape[0] == "&":
        number = re.fullmatch(r"&#(?:[xX]([0-9A-Fa-f]+)|(\d+));", escape)
        code = (int(number[1], 16) if number[1] else int(number[2])) if number else -1
        # Not as browsers do, who read 128 to 159 as another codec's signs.
        got = chr(code) if 0x80 <= code < 0xA0 else html.unescape(escape)
        return escape if got == "\ufffd" else got
    try:
        return unquote(escape, errors="strict") if escape[0] == "%" else chr(int(escape[2:], 16))
    except UnicodeDecodeError:
        return unquote(escape, encoding="latin-1")


def examine(text: str | None) -> tuple[bool, str | None]:
    """Whether ``text`` holds a garbled stretch, and the text restored as far as it can be."""
    if not text:
        return False, text
    garbled, out = _examine(text)
    opened = out
    for _ in range(DEPTH):
        if not _ESCAPE.search(opened):
            break
        opened = _ESCAPE.sub(_undo, opened)
        again, restored = _examine(opened)
        if again and not (garbled and restored == opened):
            return True, restored
    return garbled, out


def garbled_fields(df: DataFrame, key: str, fields: tuple[str, ...], remembered: int = 20_000) -> DataFrame:
    """``key, field_name, restored`` of every garbled value of ``fields``."""

    @F.pandas_udf("struct<garbled:boolean,restored:string>")
    def look(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        one = functools.lru_cache(maxsize=remembered)(examine)
        for s in batches:
            at, values = pd.factorize(s)
            got = [*map(one, values), (False, None)]
            yield pd.DataFrame({"garbled": [got[i][0] for i in at], "restored": [got[i][1] if got[i][0] else None for i in at]})

    values = df.select(F.col(key), F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("value")) for f in fields])).alias("_v")).select(key, "_v.field_name", "_v.value")
    looked = values.filter(F.col("value").rlike(CANDIDATE)).withColumn("_l", look("value"))
    return looked.filter("_l.garbled").select(key, "field_name", F.col("_l.restored").alias("restored"))
