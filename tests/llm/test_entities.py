"""Places, names, near-duplicates on small fixtures, against brute force."""

import itertools
import random

import numpy as np
import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest

from millrace.llm import names, near_duplicates as nd, places
from millrace.llm.components import components

REGION = "region_code string, level_name string, province_code string, name_zh string, name_en string, label string, aliases array<string>"
REGIONS = [
    ("000000", "nation", None, "全国", "China", "全国", ["中国", "Nationwide"]),
    ("000001", "remote", None, "全国-远程", "Remote", "全国-远程", ["远程", "Remote - China"]),
    ("670000", "province", "670000", "苍岭省", "Cangling", "苍岭省", ["苍岭"]),
    ("670100", "city", "670000", "沙棠泽市", "Shatangze", "苍岭省-沙棠泽市", ["沙棠泽"]),
    ("670300", "city", "670000", "雁坪阙市", "Yanpingque", "苍岭省-雁坪阙市", ["雁坪阙"]),
    ("770000", "province", "770000", "霁川省", "Jichuan", "霁川省", ["霁川"]),
    ("774000", "city", "770000", "燕坪阙市", "Yanpingque", "霁川省-燕坪阙市", ["燕坪阙"]),
]


def _regions(spark):
    return spark.createDataFrame(REGIONS, REGION)


def test_places(spark):
    index = places.PlaceIndex(places.load_regions(_regions(spark)))
    want = {
        "沙棠泽市学院路": "670100", "Shatangze, Cangling, China": "670100", "Shatagze": "670100", "苍岭沙唐泽": "670100", "ＳＨＡＴＡＮＧＺＥ": "670100", "沙 棠澤": "670100",
        "Yanpingque": "none", "Yanpingque, Jichuan": "774000", "远程（全国）": "000001", "remote (China)": "000001", "沙棠泽（可远程）": "670100", "中国": "000000",
        "Cangling": "670000", "TBD": "none", "Merrowick, Tessland": "none", "": "none", "???": "none",
    }
    assert {v: index.resolve(v) for v in want} == want


def test_map_places_edges(spark):
    schema = "rec_id long, location string, work_locations_raw array<string>, region_code string, piece string"
    rows = [(1, "Shatangze; Yanpingque", ["沙棠泽", None, " "], "x", "y"), (2, None, None, None, None), (3, "", [], "x", "y"), (4, "Shatangze;Shatangze", None, None, None)]
    got = sorted(map(tuple, places.map_places(spark.createDataFrame(rows, schema), _regions(spark)).collect()))
    assert got == [(1, "location", "670100"), (1, "location", "none"), (1, "work_locations_raw", "670100"), (4, "location", "670100")]
    assert places.map_places(spark.createDataFrame([], schema), _regions(spark)).count() == 0


def test_names(spark):
    firms = ["Pazlez Vimlul Tourism GmbH", "TOURISM, PAZLEZ VIMLL GMBH", "pazlez vimlul tour. gmbh", "P. Vimlul Tourism", "Pazlez Vimlul Software Inc.", "沙棠泽柏博竹科技有限公司", "柏博竹科技股份有限公司（沙棠泽）", "沙棠泽柏搏竹科技有限公司", "沙棠泽柏博竹物流有限公司", "Navrig Sikis China", "Gobdam Dojsik Textiles", "子丑寅科技有限公司", None, " "]
    jobs = spark.createDataFrame([(f, 1) for f in firms], "company string, employer int")
    sources = spark.createDataFrame([("Gobdam Dojsik Textiles Group",)], "name string")
    targets = spark.createDataFrame([("Gobdam Dojsik Textiles Group", "Textiles", ["Navrig Sikis"]), ("Pazlez Vimlul Tourism GmbH", "Tourism", []), ("Pazlez Vimlul Software Inc.", "Software", []), ("a", None, None)], "name string, industry string, aliases array<string>")
    got = {tuple(r) for r in names.name_pairs(jobs, sources, targets, _regions(spark)).collect()}
    groups = [firms[:4], firms[5:8], ["Navrig Sikis China", "Gobdam Dojsik Textiles", "Gobdam Dojsik Textiles Group"]]
    assert got == {tuple(sorted(p)) for g in groups for p in itertools.combinations(g, 2)}
    assert names.name_pairs(jobs.limit(0), sources.limit(0), targets.limit(0), _regions(spark)).count() == 0


def test_names_keep_every_line(spark):
    lines = ("textile", "textiles", "textilery", "textileware", "textilecraft")
    lex = names.Lexicon((), frozenset(), (), lines)
    assert {p.line for p in names.parse("Pazlez Vimlul Text.", lex)} == set(lines)
    shown = spark.createDataFrame([("Pazlez Vimlul Textiles",)], "text string")
    targets = spark.createDataFrame([(f"line {i}",) for i in range(4)], "industry string")
    assert len(names._lexicon(shown, _regions(spark), targets, 4).lines_latin) == 4
    with pytest.raises(ValueError):
        names._lexicon(shown, _regions(spark), targets, 3)


def test_divide_skip_is_exact():
    rng = random.Random(3)
    for _ in range(200):
        docs = [set(rng.sample(range(30), rng.randint(1, 12))) for _ in range(40)]
        lists = {t: [i for i, d in enumerate(docs) if t in d] for t in range(30)}
        query, least = rng.sample(range(30), 10), rng.randint(1, 5)
        want = {i: n for i, d in enumerate(docs) if (n := len(d & set(query))) >= least}
        for long_lists in (None, 0, 1, 3):
            assert nd.divide_skip(query, lists, least, long_lists) == want


def _postings(rng):
    words = [f"{a}{b}" for a in "甲乙丙丁戊己庚辛壬癸" for b in "子丑寅卯辰巳午未申酉戌亥"]
    text = lambda: ["".join(rng.sample(words, 5)) for _ in range(rng.randint(4, 9))]
    rows = []
    for g in range(30):
        base = text()
        for c in range(rng.randint(1, 3)):
            parts = base[:]
            rng.shuffle(parts)
            if c:
                parts[0] = parts[0][:3] + parts[0][4:]
            rows.append((f"job-{g:02d}-{c}", "岗", "公司", "。".join(parts) + "。", "x"))
    return rows


def test_near_duplicates_match_brute_force(spark):
    rows = _postings(random.Random(5))
    rows += [rows[0], ("null", None, None, None, "x"), ("blank", "t", "c", "  ", "x"), (None, "t", "c", "文字文字文字", "x"), ("long", "t", "c", "字词句段" * 20000, "x")]
    jobs = spark.createDataFrame(rows, "id string, title string, company string, description string, rep string")
    usable = {r[0]: r for r in rows if r[0] and r[3] and r[3].strip()}
    want = {(a, b) for a, b in itertools.combinations(sorted(usable), 2) if nd.agreement(nd.wording(*usable[a][1:4]), nd.wording(*usable[b][1:4])) >= nd.AGREEMENT}
    assert {tuple(r) for r in nd.near_duplicate_pairs(jobs).collect()} == want
    groups = {r["id"]: r["class_id"] for r in nd.near_duplicate_groups(jobs).collect()}
    assert set(groups) == set(usable) and all(groups[a] == groups[b] for a, b in want)
    assert nd.near_duplicate_pairs(jobs.limit(0)).count() == 0


def _edited(rng, sentence):
    """One edit: a unit replaced, left out or put in."""
    units, i = sentence[:], rng.randrange(len(sentence))
    how = rng.randrange(3)
    units[i : i + (how != 2)] = [] if how == 1 else ["改" if len(units[0]) == 1 else "edited"]
    return units


def test_recall_with_an_edit_in_every_sentence(spark):
    """2,000 records, every sentence of every variant edited once: all pairs a brute-force comparison finds."""
    rng = random.Random(8)
    letters = [chr(0x4E00 + 7 * i) for i in range(900)]
    words = [a + b for a in ("bra", "cle", "dro", "fli", "gna", "pru", "sta", "vel") for b in ("bin", "cor", "dal", "fer", "mus", "nit", "pol", "rig", "tas", "wem")]
    rows = []
    for g in range(1000):
        units, n = (letters, 26) if g % 2 else (words, 16)
        base = [[rng.choice(units) for _ in range(rng.randint(n - 4, n))] for _ in range(rng.randint(1, 6))]
        changed = [_edited(rng, x) for x in base]
        rng.shuffle(changed)
        for c, text in (("a", base), ("b", changed)):
            rows.append((f"{g:04d}{c}", "", "", "".join(("" if g % 2 else " ").join(x) + ("。" if g % 2 else ". ") for x in text)))
    counts = [nd.wording(*r[1:]) for r in rows]
    want = {(x[0], y[0]) for (x, a), (y, b) in itertools.combinations(list(zip(rows, counts)), 2) if min(len(a), len(b)) >= 0.5 * max(len(a), len(b)) and nd.agreement(a, b) >= nd.AGREEMENT}
    assert len(want) > 900
    jobs = spark.createDataFrame(rows, "id string, title string, company string, description string")
    assert {tuple(r) for r in nd.near_duplicate_pairs(jobs).collect()} == want


def test_every_pair_is_judged_on_its_own_fields(spark):
    one = "We keep every ledger of the harbour in good order and report on it"
    rows = [("a", "Senior Nurse Berlin", "Alpha Clinic GmbH", "We value curiosity."), ("b", "Forklift Driver Porto", "Omega Freight Lda", "We value curiosity."), ("c", "Clerk", "Port", one), ("d", "Clerk", "Port", one.replace("good", "fine"))]
    # An id with two texts is linked through both.
    rows += [("e", "Clerk", "Port", "全新的一段文字没有别的记录和它相同。"), ("e", "Clerk", "Port", one.replace("order", "shape")), ("f", None, None, "12 34"), ("g", None, None, "12 34")]
    jobs = spark.createDataFrame(rows, "id string, title string, company string, description string")
    assert {tuple(r) for r in nd.near_duplicate_pairs(jobs).collect()} == {("c", "d"), ("c", "e"), ("d", "e"), ("f", "g")}
    links = {r["id"]: r["links"] for r in nd.near_duplicate_groups(jobs).collect()}
    assert links == {"a": 0, "b": 0, "c": 2, "d": 2, "e": 2, "f": 0, "g": 0}


def test_copies_are_paired_in_parts(spark, monkeypatch):
    monkeypatch.setattr(nd, "PART", 7)
    rows = [(f"j{i:02d}", "t", "c", "一段被发布了许多次的文字，编号不同。") for i in range(30)] + [("k", "t", "c", "一段被发布了许多次的文字，标号不同。")]
    jobs = spark.createDataFrame(rows, "id string, title string, company string, description string")
    assert nd.near_duplicate_pairs(jobs).count() == 31 * 30 // 2


def test_hot_clause_is_searched_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK", 8)
    rows = [(f"j{i:03d}", "t", "c", f"所有文本都有的一句话。又一句大家都有的话。第{'零一二三四五六七八九'[i // 10]}{'零一二三四五六七八九'[i % 10]}号独有") for i in range(40)]
    jobs = spark.createDataFrame(rows, "id string, title string, company string, description string")
    assert nd.near_duplicate_pairs(jobs).count() == 40 * 39 // 2


def _sentence(rng, units, n):
    return "".join(rng.choice(units) for _ in range(n)) + "。"


def test_texts_of_other_wording_are_no_candidates(spark, monkeypatch):
    """Records that share as many half sentences as asked, but not their wording, aren't paired, in one list and in blocks."""
    rng, units = random.Random(4), [chr(0x4E00 + 5 * i) for i in range(1500)]
    heads = [_sentence(rng, units, 4)[:-1] for _ in range(3)]
    rows = [(f"j{i:03d}", "岗", "公司", "".join(h + _sentence(rng, units, 5) for h in heads)) for i in range(150)]
    rows += [(f"{k}x", t, c, d.replace(d[-3], "改")) for k, t, c, d in rows[:20]]
    jobs = spark.createDataFrame(rows, "id string, title string, company string, description string")
    counts = {r[0]: nd.wording(*r[1:]) for r in rows}
    want = {(a, b) for a, b in itertools.combinations(sorted(counts), 2) if nd.agreement(counts[a], counts[b]) >= nd.AGREEMENT}
    assert {(f"j{i:03d}", f"j{i:03d}x") for i in range(20)} <= want
    written, real = [], nd.materialize
    monkeypatch.setattr(nd, "materialize", lambda df: written.append(real(df)) or written[-1])
    for block in (nd.BLOCK, 16):
        monkeypatch.setattr(nd, "BLOCK", block)
        written.clear()
        assert {tuple(r) for r in nd.near_duplicate_pairs(jobs).collect()} == want
        assert next(x for x in written if x.columns == ["a", "b"]).count() <= 2 * len(want)


def test_lists_give_the_same_pairs_either_way(monkeypatch):
    """Short lists, long ones and the T-occurrence search against all pairs, whole and in blocks; batches cut lists."""
    rng, rows = random.Random(9), []
    for tok in range(40):
        left, right = ((0, 0), (0, 1))[tok % 2]
        for t in range(rng.choice((1, 2, 5, 30, 160))):
            rest = sorted(rng.sample([x for x in range(30) if x != tok], rng.randint(2, 6)))
            words = rng.randint(20, 30)
            rows.append({"tok": tok, "left": left, "right": right, "t": t, "least": rng.randint(1, 3), "words": words, "toks": rest[:1] + [tok] + rest[1:], "block": t % 2 if right else 0, "kinds": nd._kinds(rng.choices("甲乙丙丁戊己庚辛壬癸", k=words))})
    rows.sort(key=lambda r: (r["tok"], r["left"], r["right"], r["words"]))
    marks = nd.sketches([r["kinds"] for r in rows])
    table = pa.table({c: [r[c] for r in rows] for c in ("tok", "left", "right", "t", "least", "words", "toks", "block")} | dict(zip(nd._MARKS, marks.T)))
    table = table.set_column(6, "toks", table["toks"].cast(pa.list_(pa.int32())))

    def want(sketched):
        out = set()
        for i, j in itertools.combinations(range(len(rows)), 2):
            x, y = rows[i], rows[j]
            if x["tok"] != y["tok"] or (x["right"] and x["block"] == y["block"]) or set(x["toks"][:1]) & set(y["toks"][:1]):
                continue
            differing = int(np.bitwise_count(marks[i].view(np.uint64) ^ marks[j].view(np.uint64)).sum()) if sketched else 0
            if len(set(x["toks"][1:]) & set(y["toks"][1:])) >= max(x["least"], y["least"]) and nd._may_agree(np.int64(x["words"]), np.int64(y["words"]), differing):
                out.add((x["tok"], min(x["t"], y["t"]), max(x["t"], y["t"])))
        return out

    def got():
        out = set()
        for tok in range(40):
            part = table.filter(pa.compute.equal(table["tok"], tok))
            for b in nd._search(iter(part.to_batches(max_chunksize=50))):
                out |= {(tok, a, b) for a, b in zip(b["a"].to_pylist(), b["b"].to_pylist())}
        return out

    some, every = want(True), want(False)
    assert some and some < every
    assert got() == some
    monkeypatch.setattr(nd, "LONG", 4)
    assert got() == some
    monkeypatch.setattr(nd, "FEW", -1)
    assert got() == some


def test_sketches_lose_no_pair(monkeypatch):
    rng, units = random.Random(6), ["ab", "cd", "ef", "gh", *"甲乙丙丁戊己庚辛"]
    texts = [" ".join(rng.choice(units) for _ in range(rng.randint(0, 60))) for _ in range(120)]
    texts += [t + " 甲乙 ab" for t in texts] + ["", "<b>甲乙丙</b>丁 12 ab ab ab"]
    kinds = [nd.elements(t or "-")[2] for t in texts]
    wordings = [nd.wording(None, None, t) for t in texts]
    assert [len(x) // 2 for x in kinds] == [len(x) for x in wordings]
    marks = nd.sketches(kinds).view(np.uint64)
    assert nd.sketches([]).shape == (0, 4) and not nd.sketches([b"", b""]).any()
    monkeypatch.setattr(nd, "ITEMS", 100)
    assert (nd.sketches(kinds).view(np.uint64) == marks).all()
    for i, j in itertools.combinations(range(len(texts)), 2):
        differing = int(np.bitwise_count(marks[i] ^ marks[j]).sum())
        assert differing <= len(wordings[i] ^ wordings[j])
        assert nd._may_agree(np.int64(len(wordings[i])), np.int64(len(wordings[j])), differing) or nd.agreement(wordings[i], wordings[j]) < nd.AGREEMENT


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(100, 101), (101, 100), (7, 7), (None, 3)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(links).collect()}
    assert got == {i: 0 for i in range(31)} | {100: 100, 101: 100}
    assert components(links.limit(0)).count() == 0


def test_token_set_similarity():
    regions = (places.Region("0", "nation", None, ("Avaria",)), places.Region("1", "city", "p", ("New Harbor Bay",)), places.Region("2", "city", "q", ("乌兰察布", "乌兰察布市")))
    index = places.PlaceIndex(regions)
    want = {"Harbor Bay New": "1", "New Harbour": "1", "bay, new harbr": "1", "New York": None, "乌兰查布": "2", "乌察兰布": "2", "乌兰布": "2", "南方某地": None}
    assert {v: index.verdict(v) for v in want} == want
    assert places.token_set_similarity(("new", "york"), ("new", "harbor", "bay")) < places.ALIKE
    assert places.token_set_similarity((), ("a",)) == 0.0


def test_unmatched_values(spark):
    regions = spark.createDataFrame([("1", "city", "p", "沙坪崖市", "Shapingya", "x", ["沙坪崖"])], "region_code string, level_name string, province_code string, name_zh string, name_en string, label string, aliases array<string>")
    jobs = spark.createDataFrame([(1, "沙坪崖; Nowhere", ["Elsewhere", None, " "]), (2, "Nowhere", None), (2, "Nowhere", []), (3, None, ["沙坪崖"])], "rec_id long, location string, work_locations_raw array<string>")
    got = sorted(tuple(r) for r in places.unmatched_values(jobs, regions).collect())
    assert got == [("location", "Nowhere", "no entry", 2, 1.0), ("work_locations_raw", "Elsewhere", "no entry", 1, 0.5)]
    assert places.unmatched_values(jobs.limit(0), regions).count() == 0


def test_nicknames_and_acronyms(spark):
    companies = ["Robert Miller Logistics GmbH", "Robert Stone Shipping Inc.", "Bob Stone Shipping", "Hafkar Hubal Tourism Group", "HHT", "H.H.T.", "Rabid Sonar Shipping", "RSS", None, " "]
    jobs = spark.createDataFrame([(c,) for c in companies], "company string")
    targets = spark.createDataFrame([("Robert Miller Logistics GmbH", "Logistics", ["Bob Miller Logistics"]), (None, "Shipping", None), ("Oma Tours", "Tourism", [None])], "name string, industry string, aliases array<string>")
    got = {tuple(r) for r in names.name_pairs(jobs, spark.createDataFrame([], "name string"), targets, _regions(spark)).collect()}
    # Two employers have the acronym RSS, so it names neither.
    assert got == {("Bob Stone Shipping", "Robert Stone Shipping Inc."), ("HHT", "Hafkar Hubal Tourism Group"), ("H.H.T.", "Hafkar Hubal Tourism Group"), ("H.H.T.", "HHT")}


def test_many_spellings_are_paired_in_parts(spark, monkeypatch):
    monkeypatch.setattr(names, "PART", 3)
    shown = ["Pazlez Vimlul Textiles", "pazlez vimlul textiles", "PAZLEZ VIMLUL TEXTILES", "Vimlul Pazlez Textiles", "Pazlez Vimlul Textiles GmbH", "Pazlez-Vimlul Textiles", "Textiles, Pazlez Vimlul"]
    jobs = spark.createDataFrame([(c,) for c in shown], "company string")
    targets = spark.createDataFrame([("x", "Textiles", [])], "name string, industry string, aliases array<string>")
    assert names.name_pairs(jobs, spark.createDataFrame([], "name string"), targets, _regions(spark)).count() == 7 * 6 // 2
