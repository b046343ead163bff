"""Truncation, garbling, encoding, packing and repetition on small fixtures."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import garbled, packing, repetition, tokenize, truncation
from pyspark.sql import functions as F

SENTENCES = ["We operate modular systems and document each sensor.", "You will inspect the greenhouse with regional managers.", "Report to the night shift on contract quality and uptime."]
CHINESE = ["熟悉标注标准和实时检索文档，十年以上印染经验。", "与法务一起优化支付预算，全程梳理低时延票务课程。"]


def test_truncation(spark):
    rng = random.Random(1)
    whole = [" ".join(rng.choices(SENTENCES, k=3)) for _ in range(60)] + ["".join(rng.choices(CHINESE, k=3)) for _ in range(60)]
    cases = [(SENTENCES[0] + " You will inspect the greenh", True), (SENTENCES[0] + " You will inspect the", True), (SENTENCES[0][:-1], False), (CHINESE[0] + "与法务一起优化支", True), (CHINESE[0] + "熟悉标注标准和实时检索文档，十年以上印染经验", False), ("<p>" + CHINESE[0] + "</p><p>熟悉标注", True), (SENTENCES[1] + " We operate modul…", True), ("", False), (None, False), ("   ", False)]
    rows = [("t", i, "s", t, 1) for i, t in enumerate(whole + [c for c, _ in cases])]
    df = spark.createDataFrame(rows, "table_name string, row_key long, grp string, text string, cut int")
    got = {r["row_key"] for r in truncation.find_truncated(df).filter("cut").collect()}
    assert got == {len(whole) + i for i, (_, cut) in enumerate(cases) if cut}
    shares = truncation.truncation_shares(truncation.find_truncated(df)).first()
    assert shares["texts"] == len(whole) + len(cases) - 3 and shares["cut_texts"] == len(got)
    assert truncation.find_truncated(df.limit(0)).count() == 0


GARBLED = [
    ("资深仓储技师".encode().decode("latin-1"), "资深仓储技师"), ("café — “quoted”".encode().decode("cp1252", "replace").replace("�", ""), None), ("校招后端顾问（排产）".encode("gbk").decode("latin-1"), "校招后端顾问（排产）"),
    ("采购经理".encode().decode("gbk"), "采购经理"), ("Größe".encode().decode("koi8-r"), "Größe"), ("夜班运维技师".encode().decode("mac_roman"), "夜班运维技师"), ("Técnico".encode().decode("latin-1").encode().decode("latin-1"), "Técnico"), ("锟斤拷席锟斤拷师", None), ("T�cnico", None),
]
SOUND = ["GESTÃO DE IRRIGAÇÃO", "Prüfingenieur für Förderbänder", "Größe, Straße", "（Проект 4）", "«Δ» ±2 ½", "Łąka", "砚垣垭市鹭屿墩", "硯谷澤", "展示試験と電池手順書", "면적 이상", "“自研”……——", "", None, "plain"]


def test_garbled_texts():
    for text, restored in GARBLED:
        found, got = garbled.examine(text)
        assert found, text
        assert restored is None or got == restored
    for text in SOUND:
        assert garbled.examine(text) == (False, text)


def test_garbled_latin_words():
    texts = ["Fachkraft für Zähler 82", "ESTÁGIO EM PRODUÇÃO", "Außerdem übersetzen Sie 3 Pläne.", "Com área jurídica, construir irrigação", "Café manager", "à noite é boa manhã"]
    for text in texts:
        for codec in ("gbk", "big5", "cp932", "euc_jp", "euc_kr"):
            try:
                read = text.encode().decode(codec)
            except UnicodeDecodeError:
                continue
            assert garbled.examine(read) == (True, text), (codec, read)
    assert garbled.examine("熟悉标准。" + "Für Zähler".encode().decode("gbk")) == (True, "熟悉标准。Für Zähler")
    assert garbled.examine("熟悉标准" + "Für 3 Verträge".encode().decode("gbk") + "好") == (True, "熟悉标准Für 3 Verträge好")
    for text in ["负责b端c端产品", "A级 Vue组件 B端", "DNA酶 manager", "熟悉 app没 bug", "Java没C", "A股 T恤 K歌", "每week 3 days", "Nanjing路 office", "b端/c端 manager"]:
        assert garbled.examine(text) == (False, text)


def test_garbled_passage_touches_sound_text():
    sound, texts = "与法务一起优化支付预算，", ["每周跟进绿色纺纱产线，并", "绿色纺纱"]
    for text, codecs in zip(texts, (("gbk",), ("gbk", "cp932"))):
        for codec in codecs:
            read = text.encode().decode(codec)
            for before, after in [("", "监控检索模型。"), ("两段", ""), (sound * 9, sound), ("", "小山")]:
                assert garbled.examine(before + read + after) == (True, before + text + after), (codec, before, after)
    assert garbled.examine(sound * 9 + "岚渡崖鹭谷湾，") == (False, sound * 9 + "岚渡崖鹭谷湾，")


def test_garbled_text_in_escapes():
    want = {"caf&Atilde;&copy; bar": "café bar", "Ã&copy;t&Atilde;&copy;": "été", "é&#128;&#137;æ&#139;&#169;": "选择", "&#233;&#128;&#137;&#230;&#139;&#169; now": "选择 now", "caf%C3%83%C2%A9": "café", "\\u00c3\\u00a9t\\u00c3\\u00a9": "été"}
    assert {t: garbled.examine(t) for t in want} == {t: (True, x) for t, x in want.items()}
    for t in ["caf%C3%A9", "R&amp;D &nbsp; x", "100%25 %20%20", "&bogus; &#0; &#1114112; &#xFFFFFF;", "A &lt;b&gt; c &eacute;", "%FF%FE%C3", "\\ud83d"]:
        assert garbled.examine(t) == (False, t)
    read = "采购经理".encode().decode("latin-1")
    assert garbled.examine(f"R&amp;D {read}") == (True, "R&amp;D 采购经理")


def test_restoration_rate():
    """Share of passages restored to the very original, over codecs and texts; strictly decodable ones only."""
    rng, right, n = random.Random(4), 0, 0
    texts = [*CHINESE, "Fachkraft für Zähler und Prüfung", "Área jurídica e produção", "能持续出差并负责高并发票务平台"]
    for _ in range(400):
        text, codec = rng.choice(texts), rng.choice(["latin-1", "cp1252", "gbk", "mac_roman", "cp1251"])
        try:
            read = text.encode().decode(codec)
        except UnicodeDecodeError:
            continue
        n += 1
        right += garbled.examine(read) == (True, text)
    assert n > 150 and right / n >= 0.97, (right, n)


def test_garbled_fields(spark):
    rows = [(1, "采购经理".encode().decode("latin-1"), "fine", "x"), (2, None, "", "x"), (3, "ok", "两段。" + "能持续出差".encode().decode("latin-1") + "。好", None), (3, "ok", "x", "x")]
    df = spark.createDataFrame(rows, "rec_id long, title string, description string, field_name string")
    got = {(r["rec_id"], r["field_name"]): r["restored"] for r in garbled.garbled_fields(df, "rec_id", ("title", "description")).collect()}
    assert got == {(1, "title"): "采购经理", (3, "description"): "两段。能持续出差。好"}
    assert garbled.garbled_fields(df.limit(0), "rec_id", ("title",)).count() == 0


TEXTS = ["Hello  world\n\nfoo's <|endoftext|>", "", None, "能提前出差，评审冷链。", " ", "a" * 3000, "👷🏽‍♀️ naïve №5", "Hello  world\n\nfoo's <|endoftext|>"]


def test_encoding_equals_library_and_round_trips(spark):
    df = spark.createDataFrame([(i % 7, t, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, ids string")
    one = tokenize.encoder(tokenize.Tokenizer()).encode_ordinary
    for block in (1, 3, 4000):
        encoded = tokenize.encode_corpus(df, block_docs=block)
        assert sorted((r["doc_id"], r["ids"]) for r in encoded.collect()) == sorted((i % 7, one(t) if t else []) for i, t in enumerate(TEXTS))
    assert sorted(r["text"] for r in tokenize.decode_corpus(encoded).collect()) == sorted(t or "" for t in TEXTS)
    assert tokenize.encode_corpus(df.limit(0)).count() == 0


def test_decoding_of_broken_ids(spark):
    """Ids that end inside a character give replacement characters, each document for itself; an unknown id is an error."""
    one = tokenize.encoder(tokenize.Tokenizer()).encode_ordinary("岚")
    df = spark.createDataFrame([(1, one), (2, one[:1]), (3, one[1:]), (4, []), (5, None)], "doc_id long, ids array<int>")
    got = {r["doc_id"]: r["text"] for r in tokenize.decode_corpus(df).collect()}
    assert got[1] == "岚" and got[2].startswith("\ufffd") and got[3].startswith("\ufffd") and got[4] == got[5] == ""
    with pytest.raises(Exception, match="no token 60000"):
        tokenize.decode_corpus(spark.createDataFrame([(1, [60000])], df.schema)).collect()


def test_loss_is_counted_in_each_piece():
    loss = np.array([0] * 30 + [1] * 50 + [0] * 20, bool)
    assert list(tokenize.pieces_of(100, None, 40, 40)) == [(0, 40, 40), (40, 40, 40), (80, 20, 20)]
    assert list(tokenize.pieces_of(100, loss, 100, 60)) == [(0, 100, 50)]
    assert list(tokenize.pieces_of(100, loss, 100, 20)) == [(0, 50, 20), (50, 20, 20), (70, 30, 10)]
    text = "Q: who are you?\n\nA: a clerk\n问：几点"
    one = tokenize.encoder(tokenize.Tokenizer()).encode
    lengths = [len(tokenize.encoder(tokenize.Tokenizer()).decode_single_token_bytes(i)) for i in one(text)]
    begins = np.cumsum([0, *lengths[:-1]])
    answer = (begins > text.index("\n")) & (begins < len(text.split("问")[0].encode()))
    assert (tokenize._bears_loss(text, lengths) == answer).all()


def test_pack_without_ids(spark):
    df = spark.createDataFrame([(None, "same text", "faq", i) for i in range(50)] + [(1, None, None, 0), (2, "", "faq", 0)], "doc_id long, text string, doc_kind string, tokens int")
    rows = packing.pack_corpus(df, packing.Limits(10, 3, 10), group_items=10).collect()
    assert len(rows) == 50 and len({r["container_id"].split("-")[0] for r in rows}) > 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 100), st.integers(0, 100)), max_size=60))
def test_pack_respects_limits(items):
    sizes = np.array([(t, 1, min(t, x)) for t, x in items], np.int64).reshape(-1, 3)
    limits = np.array([100, 5, 80])
    sizes[:, 2] = np.minimum(sizes[:, 2], 80)
    number = packing.pack(sizes, limits)
    assert (number >= 0).all()
    for n in set(number.tolist()):
        assert (sizes[number == n].sum(axis=0) <= limits).all()


def test_pack_corpus(spark):
    texts = ["word " * n for n in (10, 200, 3000, 9000, 4096, 50)] + ["", None, "Q: why\nA: because"]
    df = spark.createDataFrame([(i, t, "faq", 1) for i, t in enumerate(texts)], "doc_id long, text string, doc_kind string, container_id int")
    rows = packing.pack_corpus(df).collect()
    one = tokenize.encoder(tokenize.Tokenizer()).encode_ordinary
    whole = {i: len(one(t)) for i, t in enumerate(texts) if t}
    assert {i: sum(r["tokens"] for r in rows if r["doc_id"] == i) for i in whole} == whole and {r["doc_id"] for r in rows} == set(whole)
    assert all(r["part_no"] == 0 for r in rows if whole[r["doc_id"]] <= 4096)
    fills: dict = {}
    for r in rows:
        fills[r["container_id"]] = fills.get(r["container_id"], 0) + r["tokens"]
    assert max(fills.values()) <= 4096
    assert packing.pack_corpus(df.limit(0)).count() == 0 and packing.container_report(packing.pack_corpus(df.limit(0))).first()["fill"] == 0.0


REPEATS = [("与法务一起优化支付预算并梳理课程。" * 4, True), ("1. buy this fine new thing now\n2. Buy this fine new thing NOW!\n", True), (" ".join(SENTENCES), False), ("。".join(CHINESE), False), ("ha " * 50, True), ("", False), (None, False), ("123 456 --", False)]


def test_repetition(spark):
    scores, _, shares = repetition.batch_scores([t for t, _ in REPEATS], exact=True)
    assert shares == pytest.approx([repetition.exact_share(t) for t, _ in REPEATS])
    assert repetition.batch_scores([])[0].size == 0
    df = spark.createDataFrame([(i, t, 0.5) for i, (t, _) in enumerate(REPEATS)], "doc_id long, text string, share double")
    got = {r["doc_id"]: r["repetitive"] for r in repetition.repetition(df).collect()}
    assert got == {i: x for i, (_, x) in enumerate(REPEATS)}
    assert repetition.repetition(df.limit(0)).count() == 0 and repetition.risk_report(df.limit(0)).count() == 0


def _counted(scores, risk):
    return {c: (sum(x >= c for x, _ in scores), sum(x >= c and not label for x, label in scores)) for c in (risk.share, *risk.lower, *risk.upper)}


def test_cutoffs_bound_false_rejection():
    """Over many drawn holdouts the true rate among the rejected breaks ``alpha`` no more often than ``delta``."""
    risk, rng, broken, cutoffs = repetition.RiskControl(alpha=0.05), np.random.default_rng(2), 0, []
    # Of the rejected at cutoff c, all repetitive texts (uniform above 1/3) and the sound ones above c.
    true = lambda c: 0.93 * max(0.0, 0.34 - c) / 0.34 / (0.93 * max(0.0, 0.34 - c) / 0.34 + 0.07 * min(1.0, (1 - c) / (2 / 3)))
    for _ in range(200):
        label = rng.random(8000) < 0.07
        score = np.where(label, 1 / 3 + rng.random(8000) * 2 / 3, rng.random(8000) * 0.34)
        cutoff, certified = repetition.choose_cutoffs({"a": _counted(list(zip(score, label)), risk)}, risk)["a"]
        assert certified
        cutoffs.append(cutoff)
        broken += true(cutoff) > risk.alpha
    assert broken <= 200 * risk.delta
    assert repetition.choose_cutoffs({"a": _counted([(0.3, False)] * 5, risk)}, risk) == {"a": (risk.share, False)}
    assert repetition.binomial_upper(0, 100, 0.95) == pytest.approx(1 - 0.05 ** (1 / 100), abs=1e-6)


def test_alpha_decides(spark):
    """The same documents under a looser bound: a lower cutoff rejects more, and nothing else confirms or vetoes it."""
    rng = random.Random(3)
    words = [f"{a}{b}" for a in ("al", "be", "ce", "du", "en", "fo") for b in ("ba", "di", "ku", "lo", "ra", "ti", "vo", "za")]
    fresh = lambda n: " ".join(rng.choice(words) + rng.choice(words) + rng.choice(words) for _ in range(n))
    texts = [(lambda p: f"{p}. {fresh(8)}. {p}.")(fresh(8)) for _ in range(300)] + [(lambda p: f"{p}. {fresh(34)}. {p}.")(fresh(8)) for _ in range(30)] + [fresh(45) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {a: {r["doc_id"] for r in repetition.repetition(df, repetition.RiskControl(alpha=a)).filter("repetitive").collect()} for a in (0.001, 0.3)}
    assert found[0.001] == set(range(300))
    assert found[0.3] == set(range(330))


def test_stored_truncation_model_decides_alike(spark, tmp_path):
    """With a stored model the same texts get the same verdicts alone, and among ten and a hundred times as many."""
    schema = "table_name string, row_key long, grp string, text string"
    corpus = [("jobs", i, "g", f"{SENTENCES[i % 3]} {SENTENCES[(i + 1) % 3]}") for i in range(60)]
    truncation.fit_truncation(spark.createDataFrame(corpus, schema)).write(str(tmp_path / "model"))
    model = truncation.TruncationModel.read(spark, str(tmp_path / "model"))
    fixed = [("jobs", 0, "g", "We operate modular systems and docu"), ("jobs", 1, "g", SENTENCES[0]), ("jobs", 2, "g", "You will inspect the greenhouse with"), ("jobs", 3, "g", None)]
    got = []
    for times in (0, 10, 100):
        more = [("jobs", 100 + i, "h", "You will inspect the greenhouse with") for i in range(times)]
        judged = truncation.find_truncated(spark.createDataFrame(fixed + more, schema), model).filter("row_key < 100")
        got.append({r["row_key"]: r["cut"] for r in judged.collect()})
    assert got[0] == got[1] == got[2] == {0: True, 1: False, 2: True}


def test_all_texts_choose_the_cutoff(spark):
    """250 distinct repetitive texts certify a cutoff, half of them don't; all are counted, copies once."""
    rng = random.Random(7)
    phrase = lambda: " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(8))
    texts = [f"{p}. {p}. {p}." for p in (phrase() for _ in range(250))]
    rows = list(enumerate(texts + texts[:40] + [phrase() for _ in range(50)] + ["", None]))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    report = repetition.risk_report(df).collect()
    assert [(r["stratum"], r["certified"], r["rejected"], r["falsely_rejected"]) for r in report] == [("latin-short", True, 250, 0)]
    got = repetition.repetition(df).filter("repetitive and certified").select("doc_id").collect()
    assert sorted(r["doc_id"] for r in got) == list(range(290))
