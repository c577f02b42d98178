"""The operators against brute force, and on nulls, empty, long, repeated and clashing input."""

import collections
import hashlib
import html
import re
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import public_tokenizers
from tagloom.llm import decontaminate, html_text, links, minhash, pieces, preferences, quality, repeats, sequences, sharding, sieve, token_counts
from tagloom.llm.fmindex import FMIndex
from tagloom.llm.links import components
from tagloom.llm.scratch import saved, shared_folder
from tagloom.llm.ship import ship

SF = "/root/testdata/sf0.001"
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture
def documents(spark):
    ship(spark)
    return spark.read.parquet(f"{SF}/documents.parquet")


def texts(frame):
    return [(r["doc_id"], r["text"] or "") for r in frame.select("doc_id", "text").collect()]


def repeats_by_force(rows, length):
    count = collections.Counter()
    data = [(i, t.encode()) for i, t in rows]
    for _, b in data:
        count.update(b[s : s + length] for s in range(len(b) - length + 1))
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if count[b[s : s + length]] > 1:
                gone[s : s + length] = b"\1" * length
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((i, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(out, key=str)


@pytest.mark.parametrize("source", ["documents", "tricky"])
def test_repeats(request, source):
    frame = request.getfixturevalue(source)
    if source == "tricky":
        frame = frame.filter("doc_id is null or doc_id <> 10")
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept_bytes"])) for r in repeats.without_repeats(frame).collect()]
    assert sorted(got, key=str) == repeats_by_force(texts(frame), 200)


def test_cut_characters_stay_whole():
    data = "aéb".encode()
    assert repeats.to_characters(data, [(0, 2)]) == [(0, 1)]
    assert repeats.to_characters(data, [(2, 4)]) == [(3, 4)]


def components_by_force(rows, width, percent):
    sets, least = [], {}
    for i, t in rows:
        w = t.encode().lower().split()
        sets.append((i, {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())))
        least[i] = i

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = root(i), root(j)
                least[max(p, q)] = min(p, q)
    return sorted((i, len(x), root(i)) for i, x in sets)


@pytest.mark.parametrize("source", ["documents", "tricky"])
def test_near_duplicates(request, source):
    frame = request.getfixturevalue(source)
    got = minhash.near_duplicates(frame, width=4).collect()
    assert len(got) == frame.count()
    expected = components_by_force([x for x in texts(frame) if x[0] is not None], 4, 80)
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is not None) == expected


def near_copies(seed):
    """Copies of one text with a few words of their own, and of versions of it with edits in common."""
    rng = np.random.default_rng(seed)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for version in range(6):
        own = list(base)
        for at in rng.integers(0, 150, 3 * version):
            own[at] = f"v{version}"
        for _ in range(25):
            copy = list(own)
            for at in rng.integers(0, 150, int(rng.integers(1, 9))):
                copy[at] = f"e{rng.integers(0, 400)}"
            rows.append((len(rows), " ".join(copy)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_of_near_copies(spark, seed):
    rows = near_copies(seed)
    ship(spark)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    expected = components_by_force(rows, 4, 80)
    found = minhash.near_duplicates(frame, width=4).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == expected
    near = frame.select(F.col("doc_id").alias("node"), F.col("doc_id").alias("label"), F.lit(7).cast("long").alias("main"))
    links = minhash._family_links(near, frame.mapInArrow(minhash.full_sets(4), minhash.SETS), 80)
    labels = {r["node"]: r["label"] for r in components(links).collect()}
    assert [(i, labels.get(i, i)) for i, _ in rows] == [(i, c) for i, _, c in expected]
    assert len({c for _, _, c in expected}) > 5


def test_differences_bring_together_only_pairs_that_can_have_enough_in_common(spark):
    """All hold a and b; both pairs of sets need two differences, and 1 and 3 have one only from b on."""
    columns = "main long, x long, node long, label long, excess long, left long"
    rows = [(7, 10, 1, 1, 200, 1), (7, 11, 1, 1, 200, 0), (7, 10, 2, 2, 200, 1), (7, 11, 2, 2, 200, 0), (7, 11, 3, 3, 200, 4)]
    parts = spark.createDataFrame(rows, columns)
    assert sorted(minhash._sharing(parts, 80).collect()) == [(7, 1, 2)]


def test_stars_take_no_round(spark, monkeypatch):
    """Links that already hang on their smallest node are saved once; a chain of them still becomes one component."""
    names = []
    monkeypatch.setattr(links, "saved", lambda frame, name: names.append(name) or saved(frame, name))
    stars = spark.createDataFrame([(k, k % 5) for k in range(5, 60)] + [(4, 4)], "node long, other long")
    assert {r["node"]: r["label"] for r in components(stars).collect()} == {k: k % 5 for k in range(60)}
    assert len(names) == 1
    chain = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(50, 49)], "node long, other long")
    assert {r["node"]: r["label"] for r in components(chain).collect()} == {k: 0 for k in range(41)} | {49: 49, 50: 49}
    assert len(names) < 10


def licensed(copies, seed=3):
    """Texts of their own words behind a common licence, and pairs of near copies of some, all in the licence's buckets."""
    rng = np.random.default_rng(seed)
    licence = [f"l{i}" for i in range(60)]
    rows = []
    for i in range(copies):
        own = [f"w{i}x{k}" for k in range(73)]
        rows.append((len(rows), " ".join(licence + own)))
        if i % 10 == 0:
            for at in rng.integers(0, 73, int(rng.integers(1, 6))):
                own[at] = f"e{i}"
            rows.append((len(rows), " ".join(licence + own)))
    return rows


def test_a_common_passage_brings_nobody_together(spark, monkeypatch):
    ship(spark)
    made = {}

    def counted(frame, name):
        made.setdefault(name, []).append(saved(frame, name))
        return made[name][-1]

    monkeypatch.setattr(minhash, "saved", counted)
    sizes = []
    for copies in (150, 300):
        made.clear()
        rows = licensed(copies)
        found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=4).collect()
        if copies == 150:
            assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == components_by_force(rows, 4, 80)
        groups = {r["component_id"] for r in found}
        assert copies <= len(groups) < len(rows)
        sizes.append(sum(table.count() for table in made["rare"] + made["pairs"]))
    assert 0 < sizes[0] and sizes[1] < 3 * sizes[0]


def test_strangers_meet_the_members_they_may_be_linked_with(spark):
    """Sets of one group with too little in common make no pairs, though they share their rarest shingles."""
    rng = np.random.default_rng(5)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for i in range(120):
        copy = list(base)
        for at in rng.integers(0, 150, 12):
            copy[at] = f"e{rng.integers(0, 400)}"
        rows.append((2 * i, " ".join(copy)))
        if i % 10 == 0:
            copy[int(rng.integers(0, 150))] = "x"
            rows.append((2 * i + 1, " ".join(copy)))
    ship(spark)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    sets = frame.mapInArrow(minhash.full_sets(4), minhash.SETS)
    alone = [F.col("doc_id").alias("node"), F.col("doc_id").alias("label"), F.lit(7).cast("long").alias("main")]
    met = frame.select(*alone, F.lit(1).cast("long").alias("bucket"))
    seen = frame.select(*alone, (F.col("doc_id") % 3 > 0).alias("near"))
    pairs = {frozenset(r) for r in minhash._strangers(met, seen, sets, 80).collect()}
    shingles = {i: {tuple(w[k : k + 4]) for k in range(len(w) - 3)} for i, w in ((i, t.split()) for i, t in rows)}
    far = [frozenset((a, b)) for a in shingles for b in shingles if a < b and 0 in (a % 3, b % 3)]
    linked = {p for p in far for a, b in [p] if 100 * len(shingles[a] & shingles[b]) >= 80 * len(shingles[a] | shingles[b])}
    assert linked and linked <= pairs
    assert len(pairs) < len(far) / 5


def test_intermediate_tables_go(spark, documents):
    folder = Path(shared_folder(spark).removeprefix("file:"))
    before = set(folder.glob("*"))
    got = minhash.near_duplicates(documents, width=4)
    left = {p.name.rsplit("-", 1)[0] for p in set(folder.glob("*")) - before}
    assert "told" in left and not left & {"signatures", "sets", "classes", "nodes", "leaders", "shared", "shingles", "apart"}
    assert got.count() == documents.count()


@pytest.mark.parametrize("most", [sieve.MOST, sieve.ROW])
def test_sieve(spark, monkeypatch, most):
    monkeypatch.setattr(sieve, "MOST", most)
    rows = spark.range(0, 20000).select(F.col("id").alias("row"), F.lit("t").alias("text"))
    rows = rows.unionByName(spark.createDataFrame([(None, "t")], "row long, text string"))
    keys = spark.range(0, 20000, 7).select(F.col("id").alias("row"))
    found = sieve.marked(rows, "row", keys)
    assert found.columns == ["row", "text", "maybe"] and found.count() == 20001
    hits = {r["row"] for r in found.filter("maybe").collect()}
    assert set(range(0, 20000, 7)) <= hits and len(hits) < 5500
    assert sieve.marked(rows, "row", keys.limit(0)).filter("maybe").count() == 0


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 101), (101, 100), (7, 7)], "node long, other long")
    assert {r["node"]: r["label"] for r in components(links).collect()} == {**{i: 0 for i in range(51)}, 100: 100, 101: 100}


def test_fm_index_finds_what_a_scan_finds():
    rng = np.random.default_rng(3)
    for _ in range(40):
        n, v = int(rng.integers(2, 200)), int(rng.integers(1, 5))
        symbols = rng.integers(0, v + 1, n)
        symbols[0] = symbols[-1] = 0
        index = FMIndex(symbols, 3)
        phrases, sizes = rng.integers(1, v + 1, (10, 4)), rng.integers(1, 5, 10)
        low, high = index.ranges(phrases, sizes)
        for p, m, a, b in zip(phrases, sizes, low, high):
            expected = [i for i in range(n - m + 1) if (symbols[i : i + m] == p[:m]).all()]
            assert sorted(index.places(np.arange(a, b))) == expected


def hits_by_force(rows, items, window):
    word = re.compile(rb"[0-9a-z\x80-\xff]+")
    windows = collections.defaultdict(set)
    for i, t in items:
        w = word.findall((t or "").encode().lower())
        for s in range(max(1, len(w) - window + 1) if w else 0):
            windows[tuple(w[s : s + window])].add(str(i))
    out = []
    for i, t in rows:
        w, hit, found = word.findall(t.encode().lower()), set(), set()
        for m in {len(x) for x in windows}:
            for s in range(len(w) - m + 1):
                if tuple(w[s : s + m]) in windows:
                    hit.update(range(s, s + m))
                    found |= windows[tuple(w[s : s + m])]
        out.append((i, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [decontaminate.BLOCK, 100])
def test_contamination(spark, documents, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK", block)
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    got = decontaminate.contamination(documents, benchmark).collect()
    expected = hits_by_force(texts(documents), [tuple(r) for r in benchmark.select("item_id", "text").collect()], 10)
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in got), key=str) == expected


def test_contamination_of_tricky_rows(spark, tricky):
    benchmark = spark.createDataFrame([(1, "again and again"), (2, None), (3, "--"), (None, "w1 w2"), (4, "W5 w6 w7"), (1, "again and again")], "item_id long, text string")
    got = decontaminate.contamination(tricky, benchmark).collect()
    expected = hits_by_force(texts(tricky), [(1, "again and again"), (4, "W5 w6 w7")], 10)
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in got), key=str) == expected
    cut = decontaminate.decontaminated(tricky, benchmark)
    assert cut.columns == tricky.columns and cut.filter("text like '%again and again%'").count() == 0
    assert decontaminate.contamination(tricky, benchmark.limit(0)).filter("n_hit > 0").count() == 0


def test_token_counts_and_sequences(spark, documents, tricky, tmp_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORD_BPE)
    frame = documents.select("doc_id", "text").unionByName(tricky.select((F.col("doc_id") + 10**6).alias("doc_id"), "text").filter("doc_id is not null"))
    ids = sorted((i, len(t.encode()), tokenizer.encode(t, add_special_tokens=False).ids) for i, t in texts(frame))
    for most in (token_counts.FREQUENT, 50, 1):
        counted = token_counts.token_counts(frame, WORD_BPE, most).collect()
        assert sorted((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in counted) == [(i, n, len(x)) for i, n, x in ids]
        assert len(token_counts.frequent_pieces(frame, WORD_BPE, most)) <= most
    manifest = sequences.write_sequences(frame, WORD_BPE, f"file://{tmp_path}/out", length=256)
    got = sequences.read_sequences(manifest).orderBy("start").collect()
    start, expected = 0, []
    for i, _, x in ids:
        expected.append((i, start, len(x) + 1, zlib.crc32(np.array([*x, 1], dtype="<u4").tobytes())))
        start += len(x) + 1
    assert [tuple(r) for r in got] == expected
    first = manifest.orderBy("part").first()
    own, mask = sequences.SequenceFile(first["file"]).sequence(0)
    assert own.tolist() == [k for _, _, x in ids for k in [*x, 1]][:256] and all(mask.to_pylist()) and own.base is not None


@pytest.mark.parametrize("source", ["documents", "tricky"])
def test_quality(request, source):
    frame = request.getfixturevalue(source)
    rows = quality.judged(frame)
    assert rows.columns == [*frame.columns, "_quality"]
    for r in rows.collect():
        text, q = r["text"] or "", r["_quality"]
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        fives = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        repeated = {k for i in range(len(words) - 4) if fives[tuple(words[i : i + 5])] > 1 for k in range(i, i + 5)}
        assert (q["n_words"], q["word_chars"], q["n_dup_lines"], q["n_repeat_words"]) == (len(words), sum(map(len, words)), len(lines) - len(set(lines)), len(repeated))
        assert q["n_symbols"] == sum(c in "#*$%&|<>" for c in text)
        assert q["base_failed"] == (len(words) < 10 or 100 * len(repeated) > 20 * len(words))
        assert not (q["kept"] and q["base_failed"])


def test_divergence(spark):
    pair = spark.createDataFrame([([1.0, 0.0], [0.0, 1.0]), ([2.0, 2.0], [5.0, 5.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<double>, b array<double>")
    assert [r[0] for r in pair.select(quality.divergence(F.col("a"), F.col("b"))).collect()] == [1.0, 0.0, None]


def test_quality_keeps_labelled_documents(spark):
    ship(spark)
    sf = "/root/testdata/sf0.01"
    rows = quality.judged(spark.read.parquet(f"{sf}/documents.parquet")).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    good = rows.filter("quality = 1 and not _quality.base_failed")
    bad = rows.filter("quality = 0")
    assert good.filter("not _quality.kept").count() == 0
    assert bad.filter("not _quality.kept").count() >= 0.6 * bad.count()


def test_quality_on_the_held_out_labels(spark):
    ship(spark)
    sf = "/root/testdata/sf0.1"
    held = spark.read.parquet(f"{sf}/labels.parquet").join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id").filter(F.crc32(F.substring("text", 1, 32)) % 2 == 1)
    rows = quality.judged(held.repartition(8)).select("quality", "_quality.*").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1 and not r["base_failed"]]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert len(good) > 1600 and good.count(False) <= 0.002 * len(good)
    assert len(bad) == 286 and bad.count(True) <= 0.03 * len(bad)
    short = [r["kept"] for r in rows if r["quality"] == 0 and not r["base_failed"] and 60 <= r["n_words"] < 100]
    assert short.count(True) <= 0.3 * len(short)


@pytest.mark.parametrize("lang", ["fr", "xx", None])
def test_a_hot_group_of_copies_is_no_reference(spark, lang):
    ship(spark)
    sf = "/root/testdata/sf0.01"
    documents = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", F.when(F.col("lang") == "fr", F.lit(lang)).otherwise(F.col("lang")).alias("lang"))
    words = documents.filter("doc_id = 0").first()["text"].split()
    junk = " ".join(f"{w}{c * 3}" for w, c in zip(words * 50, "#*$%&" * 60))
    copies = spark.range(-documents.count() // 2, 0).select(F.col("id").alias("doc_id"), F.lit(junk).alias("text"), F.lit(lang).cast("string").alias("lang"))
    verdict = lambda frame: {r["doc_id"]: r["_quality"]["kept"] for r in quality.judged(frame).collect()}
    before, after = verdict(documents), verdict(documents.unionByName(copies))
    assert {i: after[i] for i in before} == before and sum(before.values()) > 600
    assert not any(k for i, k in after.items() if i < 0)


def test_pieces_round_trip(documents, tricky):
    for frame in (documents, tricky):
        rows = pieces.decoded(pieces.encoded(frame, PIECE_BPE), PIECE_BPE)
        assert rows.filter(~pieces.round_trip(F.col("text"), F.col("decoded"))).count() == 0
        assert rows.count() == frame.count()


def test_pieces_are_those_of_the_library(documents, tricky):
    sp = pieces.model(PIECE_BPE).processor
    more = [" ", "  two   spaces  ", "▁▁ x▁", "<s> <0x0A> <unk>", "a" * 5000, "=" * 3001 + "\n" * 70 + "\t x", "http://www.example.com/" * 40, "日本語のテキスト" * 50]
    frame = documents.select("doc_id", "text").unionByName(tricky.select("doc_id", "text"))
    frame = frame.unionByName(documents.sparkSession.createDataFrame([(-i, t) for i, t in enumerate(more)], "doc_id long, text string"))
    rows = pieces.encoded(frame, PIECE_BPE).collect()
    assert len(rows) == documents.count() + tricky.count() + len(more)
    for r in rows:
        assert np.frombuffer(r["ids"], dtype="<u4").tolist() == sp.encode(r["text"]), r["doc_id"]


@pytest.mark.parametrize("kind, bytes_too", [("bpe", False), ("bpe", True), ("unigram", False)])
def test_pieces_of_other_models(tmp_path, kind, bytes_too):
    import sentencepiece

    lines = [f"{w} and the {w}ing of red {w}s" for w in "water paper stone river letter garden".split()] * 20
    sentencepiece.SentencePieceTrainer.train(
        sentence_iterator=iter(lines), model_prefix=f"{tmp_path}/m", model_type=kind, vocab_size=330 if bytes_too else 60, byte_fallback=bytes_too, user_defined_symbols=["<sep>"] if kind == "bpe" else [], hard_vocab_limit=False, minloglevel=2
    )
    own = pieces.Model(f"{tmp_path}/m.model")
    for text in ["the watering of red stones", "éé the  日本 waterstones 日", "", "x"] + (["water<sep>stone the<sep>"] if kind == "bpe" else []):
        assert np.frombuffer(own.encode(text), dtype="<u4").tolist() == own.processor.encode(text), text


def test_words_are_merged_once_a_stretch(monkeypatch):
    """New words of known stretches, and words from before the memory was full, take no merges again."""
    encoder = pieces.Model(PIECE_BPE)
    syllables = [a + b for a in ("qu", "zh", "schl") for b in ("éa", "ùo", "ïe", "öu")]
    words = [a + b + c for a in syllables for b in syllables for c in syllables]
    merged = []
    short = encoder._merged_short
    encoder._merged_short = lambda text, own: merged.append(text) or short(text, own)
    for i in range(0, len(words), 50):
        text = " ".join(words[i : i + 50])
        assert np.frombuffer(encoder.encode(text), dtype="<u4").tolist() == encoder.processor.encode(text)
    assert 0 < len(merged) < len(words) / 2
    monkeypatch.setattr(pieces, "REMEMBERED", 30)
    encoder.known, encoder.before, encoder.parts, encoder.parts_before = {}, {}, {}, {}
    for i in range(40):
        del merged[:]
        text = "hot words stay " + " ".join(f"n{i}x{k}" for k in range(20))
        assert np.frombuffer(encoder.encode(text), dtype="<u4").tolist() == encoder.processor.encode(text)
        assert i == 0 or not {"▁hot", "▁words", "▁stay"} & set(merged)


def test_streaming_search_equals_the_whole_table():
    model = pieces.Model(PIECE_BPE)
    sp = model.processor
    scores = {sp.id_to_piece(i): (sp.get_score(i), i) for i in range(len(sp)) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))}
    rng = np.random.default_rng(5)
    for _ in range(200):
        text = "".join(rng.choice(list("theinaors▁xé日\n0"), rng.integers(0, 400)))
        best, back = [0.0] + [None] * len(text), [None] * (len(text) + 1)
        for i in range(len(text)):
            for j in range(i + 1, min(len(text), i + 16) + 1):
                if text[i:j] in scores:
                    score, name = scores[text[i:j]]
                    if best[j] is None or best[i] + score > best[j]:
                        best[j], back[j] = best[i] + score, (i, name)
            if best[i + 1] is None:
                best[i + 1], back[i + 1] = best[i] + model.penalty, (i, None)
        ids, at = [], len(text)
        while at:
            at, name = back[at]
            ids += [name] if name is not None else model.fallback(text[at])[::-1]
        assert [i for part in model.segments(text) for i in part] == ids[::-1]


def test_main_text(spark):
    tree = html_text.trained(spark)
    page = (
        "<html><head><title>T</title></head><body><div class=menu><a href=x>Home</a></div><p>Hello &amp; <b>wor</b>ld<br>next  line.</p>"
        "<div class='comments'><p>Nice post you wrote there my friend</p></div><p>Second one <a href=y>with</a> unclosed"
    )
    assert html_text.main_text(page, tree) == "Hello & world next line.\nSecond one with unclosed"
    pages = spark.createDataFrame([(1, "u", None), (2, None, ""), (2, None, "<p>x"), (3, "u", "plain < 5"), (4, "u", "<!-- open"), (5, "u", "<script>x")], "page_id long, url string, html string")
    assert sorted((r["page_id"], r["text"]) for r in html_text.extracted(pages).collect()) == [(1, ""), (2, ""), (2, "x"), (3, "plain < 5"), (4, ""), (5, "")]


ARTICLE_TEXT = "Peat keeps leaves, boats and letters for a very long time, and nobody knows why it does."


@pytest.mark.parametrize(
    "around, shown",
    [
        *(
            (x, True)
            for x in (
                "<div class='overflow-hidden'>%s</div>", "<div style='overflow:hidden'>%s</div>", "<div data-hidden=false>%s</div>", "<div aria-hidden='false'>%s</div>",
                "<section id='discussion'>%s</section>", "<div class='layout has-sidebar'>%s</div>", "<article class='post category-legal'>%s</article>",
                "<div class='sidebar'><main>%s</main></div>", "<div title='class=ad hidden'>%s</div>", "<div data-class=nav>%s</div>",
            )
        ),
        *(
            (x, False)
            for x in (
                "<div hidden>%s</div>", "<div HIDDEN=''>%s</div>", "<div aria-hidden=true>%s</div>", "<div style='color:red; display : none'>%s</div>", "<div class='x site-footer'>%s</div>",
                "<div class=cookie-notice>%s</div>", "<section id=comments>%s</section>", "<div class='nav__item'>%s</div>", "<div id=ad1>%s</div>", "<div hidden><main>%s</main></div>",
            )
        ),
    ],
)
def test_attributes_that_hide(spark, around, shown):
    page = f"<body><h1>The fen</h1>{around % f'<p>{ARTICLE_TEXT}</p>'}<p>It is dug in summer, when the water is low and the days are long enough.</p></body>"
    assert (ARTICLE_TEXT in html_text.main_text(page, html_text.trained(spark))) == shown


def test_links_and_headings_keep_their_words(spark):
    page = "<article><h2 id='related-work'>Related work</h2><p>Those who dig find <a href='/hidden-gems'>many old things</a> in it every summer.</p></article>"
    assert html_text.main_text(page, html_text.trained(spark)) == "Related work\nThose who dig find many old things in it every summer."


def test_main_text_of_the_sample_pages(spark):
    ship(spark)
    for r in html_text.extracted(spark.read.parquet(f"{SF}/pages.parquet")).join(spark.read.parquet(f"{SF}/pages.parquet"), "page_id").collect():
        assert r["text"] and "&copy;" not in r["text"] and "©" not in r["text"]
        assert r["text"].split("\n")[0] in html.unescape(r["html"])


def test_preferences(spark):
    turns = [(0, 0, "user", "Hi"), (0, 1, "assistant", "Yes"), (1, 0, "user", "Hi"), (1, 1, "assistant", "No"), (1, 2, "user", None), (2, 0, "user", "x"), (3, 0, "user", "x"), (None, 0, "user", "y")]
    frame = spark.createDataFrame([(*t, "x") for t in turns], "conv_id long, turn long, role string, text string, prompt string")
    got = {r["pair_id"]: r for r in preferences.preferences(frame, preferences.neighbour_pairs(frame)).collect()}
    assert sorted(got) == [0, 1]
    first = got[0]
    assert (first["n_shared"], first["prompt"]) == (1, "<|im_start|>user\nHi<|im_end|>\n")
    cut = lambda text, mask: [text[m["start"] : m["start"] + m["length"]] for m in mask]
    assert cut(first["chosen_completion"], first["chosen_mask"]) == ["Yes<|im_end|>\n"]
    assert cut(first["rejected_completion"], first["rejected_mask"]) == ["No<|im_end|>\n"]
    assert (got[1]["n_shared"], got[1]["chosen_completion"], got[1]["n_rejected_learned"]) == (1, "", 0)
    assert preferences.preferences(frame.limit(0), preferences.neighbour_pairs(frame.limit(0))).count() == 0


def answers_by_force(turns):
    talks = collections.defaultdict(list)
    for c, n, role, text in sorted(turns, key=lambda t: (t[0], t[1], t[2], t[3] or "")):
        talks[c].append((role, text or ""))
    show = lambda talk: "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in talk)
    out = {}
    for c, talk in talks.items():
        for i, (role, text) in enumerate(talk):
            if role != "assistant":
                continue
            there = [(k != i, k, c + 1, x) for k, x in enumerate(talks.get(c + 1, [])) if x[0] == "assistant"]
            here = [(k < i, k, c, x) for k, x in enumerate(talk) if x[0] == "assistant"]
            found = [(d, x) for _, _, d, x in [*sorted(there), *sorted(here)] if x[1] != text]
            d, x = found[0] if found else (None, None)
            out[f"{c}:{i}"] = (i, show(talk[:i]), show([(role, text)]), show([x]) if x else "", c, d)
    return out


@pytest.mark.parametrize("source", ["sample", "made up"])
def test_every_answer_has_its_shared_start(spark, source):
    if source == "sample":
        from tagloom.llm import queries

        rows = queries.op6_chat_formatting(spark, SF).collect()
        turns = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
        assert sum(r["n_shared"] > 0 for r in rows) > 30
    else:
        turns = [
            (0, 0, "user", "a"), (0, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 4, "assistant", "c"), (1, 6, "user", None), (1, 7, "assistant", None),
            (5, 0, "assistant", "only"), (7, 0, "assistant", "same"), (7, 1, "assistant", "same"), (9, 0, "user", "x"), (2**63 - 1, 0, "assistant", "end"), (-(2**63), 0, "assistant", "begin"),
        ]
        rows = preferences.answers(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")).collect()
    got = {r["pair_id"]: (r["n_shared"], r["prompt"], r["chosen_completion"], r["rejected_completion"], r["chosen"], r["rejected"]) for r in rows}
    assert len(got) == len(rows) and got == answers_by_force(turns)


def test_lookup_table(spark, tricky):
    names = [f"s{i}" for i in range(7)]
    table = sharding.lookup_table(names, 1009)
    counts = collections.Counter(table)
    assert set(table) == set(range(7)) and max(counts.values()) - min(counts.values()) <= 1
    fewer = sharding.lookup_table(names[:-1], 1009)
    assert sum(a != b for a, b in zip(table, fewer) if a != 6) < 0.25 * 1009
    with pytest.raises(ValueError):
        sharding.lookup_table(names, 1000)
    rows = sharding.placed(tricky, F.col("doc_id"), names, 1009).collect()
    assert len(rows) == tricky.count() and len({r["shard"] for r in rows if r["doc_id"] == 7}) == 1
    slot = int(hashlib.md5(b"7").hexdigest()[:15], 16) % 1009
    assert {(r["slot"], r["shard"]) for r in rows if r["doc_id"] == 7} == {(slot, names[table[slot]])}


def test_empty_tables(spark, tricky):
    empty = tricky.limit(0)
    assert repeats.without_repeats(empty).count() == 0
    assert minhash.near_duplicates(empty).count() == 0
    assert quality.judged(empty).count() == 0
    assert token_counts.token_counts(empty, WORD_BPE).count() == 0
    assert pieces.encoded(empty, PIECE_BPE).count() == 0
    assert sharding.placed(empty, F.col("doc_id"), ["a"]).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, SF)
    assert rows.count() > 0 and rows.filter("not round_trip").count() == 0
    assert rows.select("doc_id").distinct().count() == rows.count()


def test_pretokens_of_long_texts_and_names(spark, monkeypatch):
    rng = np.random.default_rng(3)
    long = b" ".join(bytes(rng.integers(97, 100, n).tolist()) for n in rng.integers(1, 40, 2000))
    monkeypatch.setattr(token_counts, "STRETCH", 64)
    assert [w for words in token_counts._words(long) for w in words] == long.split()
    assert list(token_counts._words(b"")) == [[]]
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORD_BPE)
    rows = [(i, f"{'hot' * 40} {'x' * i}é {'cold' * (20 + i)}") for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id int, text string")
    for most in (token_counts.FREQUENT, 4):
        counted = token_counts.token_counts(frame, WORD_BPE, most)
        assert counted.schema["doc_id"].dataType.simpleString() == "int"
        assert sorted((r["doc_id"], r["n_tokens"]) for r in counted.collect()) == [(i, len(tokenizer.encode(t, add_special_tokens=False).ids)) for i, t in rows]
