"""Operators against plain versions, and the edge cases of helpers and stages."""

import random
import re
import unicodedata
from datetime import date

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sparquill.llm import common, decontaminate, fingerprint, pii, quality, secrets, sharding, toxicity, warc

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return {r.doc_id: r.text for r in documents.collect()}


# 1 ------------------------------------------------------------------------


def _plain_hits(text, items, width):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    hit, met = set(), set()
    for item, t in items:
        w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        size = min(width, len(w))
        for k in range(len(w) - size + 1 if w else 0):
            for i in range(len(words) - size + 1):
                if words[i : i + size] == w[k : k + size]:
                    hit |= set(range(i, i + size))
                    met |= set() if item is None else {item}
    return len(words), hit, met


def test_windows_against_plain_search(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(6)] + ["É", "ß", "x́"]
    some = lambda a, b: " ".join(rng.choices(vocabulary, k=rng.randint(a, b))).replace("w1", rng.choice(["W1", "w1,"]))
    items = [(str(i) if i else None, some(0, 12)) for i in range(25)]
    docs = {i: some(0, 60) for i in range(60)} | {60: "", 61: None, 62: "w0"}
    frame, table = spark.createDataFrame(list(docs.items()), "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string")
    for options in ({}, {"block_bytes": 5000}):
        for r in decontaminate.contamination(frame, table, width=4, **options).collect():
            n, hit, met = _plain_hits(docs[r.doc_id] or "", items, 4)
            assert (r.n_words, r.n_hit, r.item_ids) == (n, len(hit), sorted(met))
            words = [m.span() for m in decontaminate.WORD.finditer(docs[r.doc_id] or "")]
            runs = [i for i in sorted(hit) if i - 1 not in hit]
            assert [s.start for s in r.spans] == [words[i][0] for i in runs]


def test_pieces_hold_each_window_once():
    words = [f"w{i}" for i in range(57)]
    for n in (0, 1, 9, 10, 11, 20, 57):
        got = [tuple(p.split()[i : i + min(10, n)]) for p in decontaminate.pieces(" ".join(words[:n]), 10, 7) for i in range(len(p.split()) - min(10, n) + 1)]
        assert got == [tuple(words[i : i + min(10, n)]) for i in range(n - min(10, n) + 1) if n]


# 2 ------------------------------------------------------------------------


def _pass(symbols, weights, opens, hits, reach, factor, eat=False, idle=""):
    """One rule of the grammar by itself: within `reach` symbols after one of opens, hits are multiplied."""
    left, out = 0, []
    for s, w in zip(symbols, weights):
        struck = left > 0 and s in hits
        out.append(w * (factor if struck else 0.0 if s in idle else 1.0))
        left = 0 if struck and eat else reach if s in opens else max(0, left - 1)
    return out


def test_composed_grammar_equals_its_rules_one_by_one():
    rng = random.Random(6)
    machine = toxicity.grammar()
    for _ in range(3000):
        symbols = rng.choices("OOOTNRHI", k=rng.randint(0, 20))
        weights = [round(rng.random(), 3) if s in "THI" else 0.0 for s in symbols]
        w = _pass(symbols, weights, "N", "IH", 3, 0.3, eat=True)
        w = _pass(symbols, w, "R", "IH", 12, 0.6)
        w = _pass(symbols, w, "T", "I", 4, 1.5)
        w = _pass(symbols, w, "H", "TI", 4, 1.5, idle="T")
        assert machine.run(symbols, weights) == pytest.approx(sum(w))


# 4 ------------------------------------------------------------------------


def _plain_fingerprint(text):
    canon = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())
    canon = re.sub(r"[\s\x85   -     　]+", " ", canon).strip(" ").encode()
    return f"{xxhash.xxh64_intdigest(canon, 42):016x}{xxhash.xxh64_intdigest(canon, xxhash.xxh64_intdigest(b'second', 42)):016x}"


def test_fingerprints_against_plain(documents, texts):
    order = sorted(texts, reverse=True)
    for r in fingerprint.fingerprints(documents).collect():
        t, nxt = texts[r.doc_id], texts[order[(order.index(r.doc_id) + 1) % len(order)]]
        n = len(t) // 2
        own, edited, following = map(_plain_fingerprint, (t, t[: len(t) - n] + nxt[:n], nxt))
        assert (r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) == (own, edited, float(own == edited), float(own == following))


def test_one_row_of_each_group(spark):
    docs = spark.createDataFrame([(1, "x", "a"), (2, "x", "b"), (2, "y", "c"), (3, "Y ", "d"), (1, "x", "a"), (None, "x", "e"), (None, "z", "f"), (4, None, "g"), (5, "", "h")], "doc_id long, text string, mark string")
    kept = fingerprint.distinct_documents(docs)
    assert kept.columns == docs.columns and sorted(map(tuple, kept.collect()), key=str) == sorted([(1, "x", "a"), (2, "y", "c"), (None, "x", "e"), (None, "z", "f"), (4, None, "g")], key=str)
    assert fingerprint.distinct_documents(docs.limit(0)).count() == 0


def test_documents_without_ids_are_dealt_too(spark):
    docs = spark.range(400).select(F.when(F.col("id") < 100, F.col("id")).alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    rows = fingerprint.with_next(docs, carry=[], bucket_bytes=300).collect()
    assert len(rows) == 400 and len({r.next_text for r in rows}) == 400
    by = {r.text: r.next_text for r in rows}
    at, seen = "text 99", []
    for _ in range(400):  # one ring over all
        seen.append(at)
        at = by[at]
    assert at == "text 99" and len(set(seen)) == 400 and seen[:100] == [f"text {i}" for i in range(99, -1, -1)]


# 5 ------------------------------------------------------------------------


def test_archives_are_read_by_many_tasks(spark, tmp_path):
    pages = spark.range(400).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.concat(*(F.sha2(F.concat(F.col("id").cast("string"), F.lit(str(k))), 512) for k in range(20))).alias("html")).repartition(2)
    warc.write_warc(pages, str(tmp_path / "mono"))
    warc.normalise(spark, str(tmp_path / "mono"), str(tmp_path / "members")).collect()
    rows = warc.read_warc(spark, str(tmp_path / "members"), split_bytes=20_000)
    assert rows.rdd.getNumPartitions() >= 10 and rows.count() == 400 and rows.select("page_id").distinct().count() == 400


# 6 ------------------------------------------------------------------------


def _key(data):
    return (xxhash.xxh64_intdigest(data, 42)) >> 1


def test_shards_follow_the_key_order(documents, texts):
    rows = {r.doc_id: r for r in sharding.byte_shards(documents, 7).collect()}
    order = sorted(texts, key=lambda d: (_key(texts[d].encode()), _key(d.to_bytes(8, "little", signed=True))))
    places = [(rows[d].shard, rows[d].slot) for d in order]
    assert places == sorted(places)


def test_written_shards_keep_clashing_columns(spark, tmp_path):
    rows = [(i, f"text {i % 5}", i, i * 2, i * 3, "c", i * 5, i * 7) for i in range(50)] + [(None, None, 1, 1, 1, None, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, size long, h long, t long, text_crc32 string, shard long, slot long")
    sharding.write_shards(docs, str(tmp_path / "out"), 3)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert set(back.columns) == {*docs.columns, "_shard", "_slot"} and sorted(map(tuple, back.select(docs.columns).collect()), key=str) == sorted(rows, key=str)
    assert back.groupBy("_shard").agg((F.max("_slot") + 1 - F.count("*")).alias("gap")).where("gap != 0").count() == 0
    sharding.write_shards(docs.limit(0), str(tmp_path / "none"), 3)


# 7 ------------------------------------------------------------------------


def test_single_characters_are_no_rotation(spark):
    for base, signs in ((10, "0123456789"), (26, "abcdefghijklmnopqrstuvwxyz")):
        df = spark.createDataFrame([(c,) for c in signs], "s string").select("s", pii.permute(F.col("s"), "k", "t", base).alias("p"))
        got = {r.s: r.p for r in df.collect()}
        assert sorted(got.values()) == sorted(signs) and len({(signs.index(p) - signs.index(s)) % base for s, p in got.items()}) > 2


def _plain_kind(s):
    """What a candidate is, by rules written down anew."""
    digits = [int(c) for c in s if c.isdigit()]
    whole = lambda p: re.fullmatch(p, s)
    if "@" in s:
        return "email"
    if whole(pii.PATTERNS["iban"]):
        bare = s.replace(" ", "")
        if int("".join(str(int(c, 36)) for c in bare[4:] + bare[:4])) % 97 == 1:
            return "iban"
    if s.startswith("+"):
        return "phone" if 8 <= len(digits) <= 15 else None
    for pattern, order in ((r"(\d{4})-(\d\d)-(\d\d)|(\d{4})/(\d\d)/(\d\d)", "ymd"), (r"(\d\d)[/](\d\d)[/](\d{4})|(\d\d)[.](\d\d)[.](\d{4})", "dmy")):
        if m := whole(pattern):
            parts = [int(x) for x in m.groups() if x]
            tries = [parts] if order == "ymd" else [parts[::-1], *([[parts[2], parts[0], parts[1]]] if "/" in s and parts[1] > 12 else [])]
            for y, mo, d in tries:
                try:
                    return "date" if 1800 <= date(y, mo, d).year <= 2199 else None
                except ValueError:
                    continue
            return None
    if m := whole(r"(\d{3})-(\d\d)-(\d{4})"):
        return "ssn" if m[1] not in ("000", "666") and m[1][0] != "9" and m[2] != "00" and m[3] != "0000" else None
    if whole(r"(\d{1,3}\.){3}\d{1,3}"):
        return "ip" if all(int(x) < 256 for x in s.split(".")) else None
    if 13 <= len(digits) <= 19 and whole(r"[\d -]+"):
        doubled = [sum(divmod(2 * d, 10)) for d in digits[-2::-2]]
        return "card" if (sum(digits[-1::-2]) + sum(doubled)) % 10 == 0 else None
    return None


def test_kinds_against_plain_rules(spark):
    rng = random.Random(9)
    d = lambda n: "".join(rng.choices("0123456789", k=n))
    makers = [
        lambda: f"{d(3)}-{d(2)}-{d(4)}", lambda: f"{rng.choice('69012')}{d(2)}-00-{d(4)}", lambda: ".".join(str(rng.randint(0, 300)) for _ in range(4)), lambda: d(16), lambda: f"{d(4)} {d(4)} {d(4)} {d(4)}",
        lambda: f"{rng.randint(1700, 2300)}-{rng.randint(0, 13):02d}-{rng.randint(0, 32):02d}", lambda: f"{rng.randint(1, 31):02d}/{rng.randint(1, 31):02d}/{rng.randint(1900, 2020)}",
        lambda: f"{rng.randint(0, 32):02d}.{rng.randint(0, 13):02d}.{rng.randint(1900, 2020)}", lambda: f"+{d(2)} {d(3)} {d(4)} {d(2)}", lambda: f"GB{d(2)} WEST {d(4)} {d(4)} {d(4)} {d(2)}", lambda: f"a{d(2)}@b.example",
    ]
    values = sorted({rng.choice(makers)() for _ in range(4000)}) + ["666-12-3456", "4111 1111 1111 1111", "GB82 WEST 1234 5698 7654 32", "12/25/2023", "25/12/2023", "13/13/2023"]
    got = spark.createDataFrame([(v,) for v in values], "s string").select("s", pii.kind_of(F.col("s")).alias("k")).collect()
    assert {r.s: r.k for r in got} == {v: _plain_kind(v) for v in values} and len({r.k for r in got}) == 8


def test_month_first_dates(spark):
    docs = spark.createDataFrame([(1, "on 12/25/2023 and 2023-12-25 but 13/13/2023")], "doc_id long, text string")
    (r,) = pii.pseudonyms(docs, "k").collect()
    m = re.fullmatch(r"on (\d\d)/(\d\d)/(\d{4}) and (\d{4})-(\d\d)-(\d\d) but 13/13/2023", r.text)
    assert r.n_date == 2 and (m[3], m[1], m[2]) == (m[4], m[5], m[6]) != ("2023", "12", "25")


# 8 ------------------------------------------------------------------------


def test_links_against_all_pairs_of_random_texts():
    from tests.llm.test_secrets import _linked

    rng, linked = random.Random(10), 0
    token = lambda n: "".join(rng.choices("abcdefXYZ0123456789", k=n))
    bits = [
        lambda: f"password={token(rng.randint(8, 40))}", lambda: f"client_id: {token(rng.randint(2, 300))}", lambda: f"https://{token(5)}.example/?host={token(6)}&{'p' * rng.randint(1, 1300)}",
        lambda: f"host = {token(9)}.example", lambda: f" {token(rng.randint(15, 600))} ", lambda: "ab12" * rng.randint(3, 30), lambda: "AKIA" + token(18).upper(), lambda: "y " * rng.randint(1, 150), lambda: "\n \n",
    ]
    for _ in range(3000):
        text = " ".join(rng.choice(bits)() for _ in range(12))
        strong, weak = secrets.strong_spans(text), secrets.weak_parts(text)
        got = secrets.linked(text, strong, weak, 200)
        assert got == _linked(text, strong, weak, 200)
        linked += len(got)
    assert linked > 3000


# 9 ------------------------------------------------------------------------


def test_scores_against_a_plain_sum():
    rng = np.random.default_rng(3)
    model = quality.Attention(rng.normal(size=(quality.WIDTH, 4)), rng.normal(size=(quality.WIDTH, 4)), rng.normal(size=4), rng.normal(size=quality.WIDTH), 0.3, rng.normal(size=quality.WIDTH), rng.uniform(1, 2, quality.WIDTH))
    for text in ("", "one short text", "many words of a text, " * 900, "é ü 1 2 3 !!! " * 400):
        total, out = 0.0, 0.0
        for p in quality.passages(text):
            h = (quality.encode(p) - model.mean) / model.scale
            gate = [np.tanh(h @ model.v[:, k]) / (1 + np.exp(-np.clip(h @ model.u[:, k], -30, 30))) for k in range(4)]
            weight = np.exp(sum(g * w for g, w in zip(gate, model.w)))
            total, out = total + weight, out + weight * (h @ model.c)
        assert model.score(text) == pytest.approx(1 / (1 + np.exp(-np.clip(out / total + model.b, -30, 30))), rel=1e-6)


# 3 ------------------------------------------------------------------------


def test_components_in_rounds_and_at_once(spark):
    from sparquill.llm import simhash

    rng = random.Random(11)
    edges = sorted({tuple(sorted(rng.sample(range(400), 2))) for _ in range(330)} | {(i, i + 1) for i in range(500, 560)})
    frame = spark.createDataFrame(edges, "a long, b long").repartition(5)
    at_once, in_rounds = ({tuple(r) for r in simhash.components(frame, room=n).collect()} for n in (10_000, 0))
    root = {x: x for e in edges for x in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert at_once == in_rounds == {(n, r) for n, r in root.items() if n != r}
    assert simhash.components(frame.limit(0)).count() == 0


# samples and stages ---------------------------------------------------------


def test_sample_size(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("toxic"))
    assert 60 < common.labelled(docs, labels, "toxic", F.lit(True), max_rows=100).count() < 140
    assert common.labelled(docs, labels, "toxic", F.lit(True), max_rows=5000).count() == 4000


DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, found string, print long, sha binary, own string, row string"


def test_stages_on_odd_documents(spark):
    import corpus_pipeline

    long = "some words of a very long text that repeats " * 3000
    texts = ["a plain text of several words, one two three four five six seven", "", None, long, "Ünï Çödé ﬁ", " \t\n", "password=abcdefghijkl1"]
    rows = [(i, t, "en", None, None, 0.5, "f", i, b"x", "o", "r") for i, t in enumerate(texts)]
    rows += [rows[0], (None, texts[0], *[None] * 9), (None, None, *[None] * 9)]
    docs = spark.createDataFrame(rows, DOCS)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for case in (docs, docs.limit(0)):
            out = stage(spark, case, DATA)
            assert out.columns == docs.columns, name
            kept = out.collect()
            if case is not docs:
                assert kept == []
            elif name == "near-dedup":
                assert sorted(r.doc_id for r in kept if r.doc_id is not None) == [0, 0, 1, 3, 4, 6] and sum(r.doc_id is None for r in kept) == 2
            elif name == "benchmark decontamination":
                assert len(kept) == len(rows)
            elif name == "secret scans":
                assert {r.doc_id: r.text for r in kept if r.doc_id is not None} == {i: t if i < 6 else "[SECRET]" for i, t in enumerate(texts)}
                assert {r.doc_id: r.n_chars for r in kept}[2] is None
    packed = corpus_pipeline.pack(spark, docs, DATA).collect()
    assert sum(r.start == 0 for r in packed) == len(rows) and corpus_pipeline.pack(spark, docs.limit(0), DATA).count() == 0


def test_shared_folder(spark):
    path = common.scratch(spark, "x")
    assert path.startswith(common.checkpoint_dir(spark)) and common.scratch(spark, "x") != path
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    common.remove(spark, path)
    import os

    assert not os.path.exists(path.removeprefix("file:"))


# words beyond the symbols -----------------------------------------------------


def test_words_of_two_symbols(monkeypatch):
    """Few words of one symbol, so that most take two, in every mixture."""
    monkeypatch.setattr(decontaminate, "SINGLES", 3)
    monkeypatch.setattr(decontaminate, "TRAILS", 2)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(14)]
    items = [(str(i), " ".join(rng.choices(words, k=rng.choice([1, 2, 4, 9, 13])))) for i in range(25)]
    found = decontaminate.automaton(items, 10)
    for _ in range(60):
        text = " ".join(rng.choices([*words, "other"], k=60)) + " " + rng.choice(items)[1]
        n, met, runs = decontaminate.scan(text, found)
        assert (n, {i for a, b, _, _ in runs for i in range(a, b + 1)}, met) == _plain_hits(text, items, 10)


def test_automaton_above_the_symbols():
    """112,000 items of ten words each, all distinct: more words than there are characters."""
    items = [(str(i), " ".join(f"x{10 * i + k}" for k in range(10))) for i in range(112_000)]
    found = decontaminate.automaton(items, 10)
    for i in (0, 99_999, 100_000, 111_999):
        assert decontaminate.scan(f"a {items[i][1]} b", found) == (12, {str(i)}, [(1, 10, 2, 2 + len(items[i][1]))])
    assert decontaminate.scan(items[5][1] + " " + items[111_000][1][:-1], found)[1] == {"5"}
