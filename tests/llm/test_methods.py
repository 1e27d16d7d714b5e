"""The operators' inner methods against plain versions on random input."""

import random
from collections import defaultdict

import numpy as np
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import decontamination, line_quality, piece_bpe, secret_scan, simhash, toxicity, transcripts, url_filter
from tidemark.llm import queries as q
from tidemark.llm.components import components


def test_automaton_on_random_words():
    rng = random.Random(3)
    for trial in range(300):
        letters, window = "ab" if trial % 2 else "abc", rng.choice([3, 4, 10])
        items = [(str(i), [rng.choice(letters).encode() for _ in range(rng.randint(0, 14))]) for i in range(4)]
        automaton = decontamination.Automaton(items, window)
        words = [rng.choice(letters + "z").encode() for _ in range(40)]
        hit, found = set(), set()
        for name, item in items:
            for k in range(max(1, len(item) - window + 1) if item else 0):
                part = item[k:k + window]
                for at in range(len(words) - len(part) + 1):
                    if words[at:at + len(part)] == part:
                        hit.update(range(at, at + len(part)))
                        found.add(name)
        spans, names = automaton.hits(words)
        assert {i for s, e in spans for i in range(s, e)} == hit and names == found


def test_items_in_parts(spark, texts):
    docs = spark.createDataFrame(texts[:300], "doc_id long, text string")
    items = q.table(spark, "/root/testdata/sf0.01", "benchmark")
    once = decontamination.find_hits(docs, items).drop("text")
    parts = decontamination.find_hits(docs, items, part_words=60).drop("text")
    assert sorted(map(str, once.collect())) == sorted(map(str, parts.collect()))


def test_no_plan_holds_more_than_a_few_automata(spark, texts):
    docs = spark.createDataFrame(texts[:20], "doc_id long, text string")
    items = spark.createDataFrame([(i, f"word{i} " * 30) for i in range(12)], "item_id long, text string")
    found = decontamination.find_hits(docs, items, part_words=30)
    plan = found._jdf.queryExecution().logical().toString()
    assert 1 <= plan.count("MapInArrow") <= decontamination.PARTS_AT_ONCE
    assert found.count() == 20


@pytest.mark.parametrize("toxic", [1, 15, 20])
def test_the_prior_is_the_share_of_toxic_labels(spark, monkeypatch, toxic):
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda sample, prior: seen.append(prior))
    docs = spark.createDataFrame([(i, "some text") for i in range(20)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < toxic)) for i in range(20)], "doc_id long, toxic int")
    toxicity.train(docs, labels)
    assert seen == [min(toxic / 20, 1 - 1e-4)]


def test_cutting_spans():
    cut = decontamination.without_spans("A b, c! D é.\nx".encode(), [(1, 3), (4, 5)]).decode()
    assert cut == "A ! D .\nx"


@pytest.mark.parametrize("limit", [4096, 20, 3])
def test_links_of_dense_fingerprints(spark, limit):
    rng = np.random.default_rng(1)
    prints = set()
    for base in rng.integers(0, 2**63, size=4).tolist():
        for _ in range(120):
            value = base
            for bit in rng.choice(64, rng.integers(0, 7), replace=False).tolist():
                value ^= 1 << bit
            prints.add(value)
    values = np.array(sorted(prints), np.uint64)
    near = np.bitwise_count(values[:, None] ^ values[None]) <= 4
    label = np.arange(len(values))
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            break
        label = new
    want = defaultdict(set)
    for value, mark in zip(values.view(np.int64).tolist(), label.tolist(), strict=True):
        want[mark].add(value)
    fps = spark.createDataFrame([(v,) for v in values.view(np.int64).tolist()], "fp long")
    got = defaultdict(set)
    for node, root in components(simhash.fingerprint_links(fps, 4, limit)).collect():
        got[root].add(node)
    assert all(min(group) == root for root, group in got.items())
    assert sorted(map(sorted, got.values())) == sorted(sorted(g) for g in want.values() if len(g) > 1)


def test_components_of_a_long_path(spark):
    edges = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    edges = edges.unionByName(spark.createDataFrame([(500, 501), (7, 7)], "a long, b long"))
    roots = dict(components(edges).collect())
    assert roots == {**dict.fromkeys(range(201), 0), 500: 500, 501: 500}


def test_merge_rounds_on_random_text():
    path = q.piece_model()
    lib, model = sentencepiece.SentencePieceProcessor(model_file=path), piece_bpe.PieceModel(path)
    rng = random.Random(1)
    parts = ["a", "b", "the", " ", "  ", "\n", "\t", "▁", "é", "ñ", "😀", "日", "本", "\x00", "#", "aa", "in", "ing", " th",
             "\r", "　", "ﬁ", "́", "0", "</s>", "<0x0A>", "ß", "한국"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 50))) for _ in range(3000)]
    texts += ["a" * 3000, "ab" * 500, " " * 70, "▁" * 33 + "x"]
    for encoder in (piece_bpe.Encoder(model), piece_bpe.Encoder(model, limit=50, slice_chars=9)):
        for text, (ids, data) in zip(texts, encoder.encode(texts), strict=True):
            want = lib.encode(text)
            assert [int(i) for p in ids for i in p.split()] == want
            assert data.decode().removeprefix(" ") == lib.decode(want) == model.decode(want)
    for ids in ([2], [], [28705], [3, 28705], [0], [264, 0, 264], [1, 264], [242, 192], [13, 259]):
        assert model.decode(ids) == lib.decode(ids)


def test_decoding_stored_ids(spark):
    docs = spark.createDataFrame([(1, "a  b\nc ▁"), (2, None)], "doc_id long, text string")
    coded = piece_bpe.encode_documents(docs, q.piece_model(), with_ids=True)
    got = piece_bpe.decode_documents(coded, q.piece_model()).select("doc_id", "decoded").collect()
    assert sorted(map(tuple, got)) == [(1, "a  b\nc  "), (2, "")]


def test_longest_rule_wins(spark):
    rows = [(1, "http://EXAMPLE.org/es/x"), (2, "http://a.example.org/en/12?q"), (3, "http://badexample.org/es/x"),
            (4, "https://x.com/fr/"), (5, "nothing"), (6, None), (7, "ftp://h#/"), (8, "http://listed.net/a/?utm_x")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    listed = spark.createDataFrame([("http://www.listed.net/a",), (None,), ("none",)], "url string")
    got = url_filter.url_filter(pages, listed, q.URL_RULES, broadcast_bytes=0).collect()
    assert {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got} == {
        1: ("example.org", "/es/x", "example.org/es/", "block"),
        2: ("a.example.org", "/en/12", "example.org/en/1", "block"),
        3: ("badexample.org", "/es/x", "org/", "allow"), 4: ("x.com", "/fr/", "com/fr/", "allow"),
        5: ("", "", None, "allow"), 6: ("", "", None, "allow"), 7: ("h", "", None, "allow"),
        8: ("listed.net", "/a/", None, "block"),
    }


def test_bloom_has_no_false_negative(spark):
    keys = spark.range(5000).select(F.concat(F.lit("http://h"), F.col("id") % 50, F.lit(".org/"), "id").alias("url"))
    for bits in (1, 16):  # a crowded filter only sends more to the exact join
        got = url_filter.url_filter(keys, keys.filter("hash(url) % 3 = 0"), bits_per_key=bits)
        wrong = got.filter((F.col("verdict") == "block") != F.expr("hash(url) % 3 = 0"))
        assert wrong.count() == 0


def test_lines_of_many_documents_go(spark):
    rows = [(i, f"Share  THIS page {i % 10}\nown words of page {'abcdefghij'[i % 10]} {'xyz'[i // 10]} are "
                "enough to stay in the corpus for good", "h") for i in range(30)]
    rows += [(99, "Share this page 7\n" * 3 + "few", "h"), (100, "Share this page 7\nword " + "other words here " * 4, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in line_quality.quality_rules(docs, max_documents=20).collect()}
    assert all(got[i]["removed_words"] == 4 and got[i]["kept"] for i in range(30))
    assert got[99]["removed_words"] == 12 and not got[99]["kept"]
    assert got[100]["removed_words"] == 0  # another host
    clean = {r["doc_id"]: r["text"] for r in line_quality.remove_lines(docs, max_documents=20).collect()}
    assert clean[99] == "few" and clean[0].startswith("own words") and clean[100].startswith("Share")


def test_copies_of_a_page_are_documents(spark):
    page = "One line of a page that was copied under many ids\nand another one of the same page here"
    rows = [(i, page, "h") for i in range(40)] + [(100 + i, page, "k") for i in range(20)]
    rows += [(200 + i, f"own words only of page number {chr(97 + i % 26)}{chr(97 + i // 26)} in a large host", "h") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in line_quality.quality_rules(docs).collect()}
    assert all(got[i]["removed_words"] == 19 and not got[i]["kept"] for i in range(40))
    assert all(got[100 + i]["removed_words"] == 0 and got[100 + i]["kept"] for i in range(20))
    assert all(got[200 + i]["kept"] for i in range(600))


def test_one_transcript_of_many_long_rows(spark):
    raw = q.raw_transcripts(q.table(spark, "/root/testdata/sf0.001", "conversations"))
    model = transcripts.train(raw)
    names = ["User: ", "Assistant: ", "", "System: "]
    rows = [("one", i, names[i % 4] + f"row {i} " * (1 if i % 5 else 2_000) + ("?" if i % 3 else "\nmore\n")) for i in range(300)]
    rows += [(None, 1, None), (None, 2, "Human: hi"), ("two", 1, "x" * 300_000)]
    df = spark.createDataFrame(rows, "conv_id string, seq long, text string")

    def whole(**options):
        parts = sorted((str(r["conv_id"]), r["turn"], r["part"], r["role"], r["rendered"]) for r in transcripts.parse(df, model, **options).collect())
        texts = {}
        for conv, _, _, _, rendered in parts:
            texts[conv] = texts.get(conv, "") + rendered
        return texts, {(c, t, role) for c, t, _, role, _ in parts}

    want = whole(chunk_rows=10**9)
    assert set(want[0]) == {"one", "two", "None"}
    assert whole(chunk_rows=3, fan=4) == want and whole(chunk_rows=16) == want


def test_network_finds_bare_secrets():
    rng = random.Random(5)
    windows, labels = [], []
    for i in range(400):
        secret = i % 2 == 0
        body = "".join(rng.choice("0123456789abcdef" if secret else "0123456789") for _ in range(30 if secret else 16))
        text = f'see {"token = " if secret else "card "}"{body}" there'
        at = text.index(body)
        windows.append(secret_scan.window(text, at, at + len(body)))
        labels.append(float(secret))
    net = secret_scan.fit(windows, np.array(labels))
    text = "plain " + "9f3c" * 8 + "g7 and 4485" + "3" * 12 + " end"
    assert [s[1] for s in secret_scan.scan_texts([text], net)[0]] in ([2], [2, 3])
    bare = secret_scan.window("here 9f3c0a71bc28d94e6f01 is", 5, 25)
    card = secret_scan.window("here 4485003371029985 is", 5, 21)
    chances = net.probabilities([bare, card])
    assert chances[0] > net.threshold > chances[1]


class Marked:
    """A network that finds the candidates with Q7xZ."""

    threshold = 0.5

    def probabilities(self, windows):
        middle = slice(secret_scan.BEFORE, -secret_scan.AFTER)
        return np.array([float("Q7xZ" in w[middle]) for w in windows])


def test_network_sees_whole_candidates(spark):
    path, hexes = "/".join(["some", "long", "way"] * 9), "9f3c" * 6
    texts = [f"see {path}/Q7xZ/{path} there", "a short wQ7xZw here", f"key wwQ7xZ{hexes}vvQ7xZ end", f"key {hexes} end",
             f"password=Q7xZ{hexes}", f"plain {path} text"]
    found = [[(k, t[s:e]) for s, k, e in spans]
             for t, spans in zip(texts, secret_scan.scan_texts(texts, Marked()), strict=True)]
    assert found == [
        [(3, f"{path}/Q7xZ/{path}")], [(3, "wQ7xZw")], [(3, "wwQ7xZ"), (2, hexes), (3, "vvQ7xZ")], [(2, hexes)],
        [(0, texts[4]), (2, hexes)], []]
    docs = spark.createDataFrame([(t,) for t in texts[:3]], "text string")
    assert [r["text"] for r in secret_scan.redact(docs, Marked()).collect()] == [
        "see [SECRET] there", "a short [SECRET] here", "key [SECRET] end"]
    for start, end in [(0, 1), (3, 51), (0, 49), (5, 200), (0, 64)]:
        parts = secret_scan.slices(start, end)
        assert (parts[0][0], parts[-1][1]) == (start, end)
        for at in range(start, end - secret_scan.HEAD + 1):
            assert any(s <= at and at + secret_scan.HEAD <= e for s, e in parts)


def test_labels_and_logits_of_windows():
    text = 'password = "abcdefgh" and plain words 1234567890123456'
    kinds = {w[secret_scan.BEFORE:].split("\0")[0]: k for w, k in secret_scan.labelled(text)}
    assert kinds == {"abcdefgh": secret_scan.FOUND, "1234567890123456": secret_scan.DIGITS}  # the keyword is left out
    assert [k for _, k in secret_scan.labelled("ordinary")] == [secret_scan.PLAIN]
    codes = np.random.default_rng(6).integers(0, 128, (150, secret_scan.WIDTH))
    net = secret_scan.CharNet.fresh()
    assert np.abs(net.forward(codes)[0] - net.logits(codes)).max() < 1e-4


def test_examples_are_those_of_least_hash(spark):
    texts = [f"key = 'token: {i:06d}abcdef' plain{chr(97 + i % 26) * 7} words{i} 2024-01-{i:06d}" for i in range(300)]
    docs = spark.createDataFrame([*enumerate(texts), (900, None), (901, ""), (None, texts[0])], "doc_id long, text string")
    kinds = {}
    for t in texts:
        for w, k in secret_scan.labelled(t):
            kinds[w] = min(k, kinds.get(w, k))
    want = []
    for kind in (secret_scan.FOUND, secret_scan.DIGITS, secret_scan.PLAIN):
        ranked = sorted((xxhash.xxh64_intdigest(w.encode(), 42) >> 1, w) for w, k in kinds.items() if k == kind)
        want += [(w, kind) for _, w in ranked[:40]]
    got = secret_scan.examples(docs.repartition(5), max_windows=40)
    assert list(zip(*got, strict=True)) == sorted(want)
    assert secret_scan.examples(docs.limit(0)) == ([], [])


def test_forms_that_were_held_out(spark):
    """Two forms that no training example has; plain texts give next to no span."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    net = secret_scan.train(docs, forms=[f for f in secret_scan.FORMS if f not in ("mixed", "upper")])
    rng = random.Random(99)
    for form in ("mixed", "upper"):
        keys = ["".join(rng.choice(secret_scan.FORMS[form]) for _ in range(rng.choice([20, 32, 40]))) for _ in range(200)]
        found = secret_scan.scan_texts([f"see the value {k} in here" for k in keys], net)
        assert sum((14, 3, 14 + len(k)) in spans for k, spans in zip(keys, found, strict=True)) >= 160
    texts = [r["text"] or "" for r in docs.collect()]
    runs = sum(1 for t in texts for _ in secret_scan.uncovered(t, secret_scan.base_spans(t)))
    added = sum(k == 3 for spans in secret_scan.scan_texts(texts, net) for _, k, _ in spans)
    assert runs > 100_000 and added <= 100e-6 * runs


def test_made_examples():
    text = "password = 'abcdefgh' and ordinary wordless runners"
    windows, kinds = map(list, zip(*sorted(set(secret_scan.labelled(text))), strict=True))
    made, labels = secret_scan.varied(windows, kinds, redraws=20)
    assert made[:len(windows)] == windows and len(set(made)) == len(made) == len(labels)
    assert (secret_scan.varied(windows, kinds, redraws=20)[1] == labels).all()
    assert {len(w) for w in made} == {secret_scan.WIDTH} and labels.sum() == 1 + 20 * len(secret_scan.FORMS)
    plain = [(w, k) for w, k in zip(windows, kinds, strict=True) if k != secret_scan.FOUND]
    assert len(secret_scan.varied(*map(list, zip(*plain, strict=True)))[0]) == len(plain)  # no finding: nothing is made
    rng = random.Random(1)
    for form, letters in secret_scan.FORMS.items():
        for _ in range(50):
            value = secret_scan.redrawn(rng, form)
            assert 16 <= len(value) <= 48 and len(set(value) - set(letters + "=_-abcdefghijklmnopqrstuvwxyz")) == 0


def test_gradients_of_the_network():
    rng = np.random.default_rng(2)
    net = secret_scan.CharNet.fresh(size=3, filters=4)
    codes, slope = rng.integers(0, 128, (3, secret_scan.WIDTH)), rng.normal(size=3)
    _, state = net.forward(codes)
    for values, found in zip(net.parameters(), net.gradients(state, slope), strict=True):
        for _ in range(5):
            at = tuple(rng.integers(0, n) for n in values.shape)
            keep, step = values[at], 1e-6
            values[at] = keep + step
            up = net.forward(codes)[0] @ slope
            values[at] = keep - step
            down = net.forward(codes)[0] @ slope
            values[at] = keep
            assert abs((up - down) / (2 * step) - found[at]) < 1e-4


def test_unlabelled_positives_are_found():
    """Hidden toxic rows among the unlabelled do not push the telling words down."""
    rng = np.random.default_rng(4)
    n = 600
    hidden = rng.random(n) < 0.3
    known = hidden & (rng.random(n) < 0.5)
    rows, cols = [], []
    for i in range(n):
        words = [*rng.choice(np.arange(3, 40), 8, replace=False), *([int(rng.integers(0, 3))] if hidden[i] else [])]
        rows += [i] * len(words)
        cols += words
    row, col = np.array(rows), np.array(cols)
    w, bias = toxicity.fit_nnpu(row, col, n, 40, known.astype(float), np.ones(n), 0.3)
    z = bias + np.bincount(row, w[col], n)
    assert ((z > 0) == hidden).mean() > 0.97 and w[:3].min() > 3 * np.abs(w[3:]).max()


def test_training_sees_all_documents(spark):
    """Every finding and every run of all documents, whatever their partitions; shards share the work."""
    rng = random.Random(5)
    texts = [f"key = 'token: {i:06d}abcdef' plain{chr(97 + i % 26) * 7} words{i} 2024-01-{i:06d} {'xy' * (i % 40)}" for i in range(400)]
    texts += [" ".join("".join(rng.choice("etaoinshrdlu") for _ in range(9)) for _ in range(20)) for _ in range(200)]
    docs = spark.createDataFrame([*enumerate(texts), (900, None), (901, ""), (902, texts[0])], "doc_id long, text string")
    found, runs = set(), {}
    for t in texts:
        for w, k in secret_scan.labelled(t):
            run = w[secret_scan.BEFORE:-secret_scan.AFTER].rstrip("\0")
            if k == secret_scan.FOUND:
                found.add(w)
            else:
                runs[run] = min(k, runs.get(run, k))
    got = [sorted(map(tuple, secret_scan.distinct_windows(docs.repartition(n)).collect())) for n in (1, 5)]
    assert got[0] == got[1]
    assert {w for w, k in got[0] if k == secret_scan.FOUND} == found
    assert sorted((w[secret_scan.BEFORE:-secret_scan.AFTER].rstrip("\0"), k) for w, k in got[0] if k) == sorted(runs.items())
    nets = [secret_scan.train(docs.repartition(n), per_shard=2000) for n in (1, 5)]
    assert len(got[0]) > 4000 and nets[0].threshold == nets[1].threshold < 1
    assert all((a == b).all() for a, b in zip(nets[0].parameters(), nets[1].parameters(), strict=True))


class Listening:
    """A network that finds nothing and keeps the windows that it is asked for."""

    threshold = 0.5

    def __init__(self):
        self.asked, self.calls = [], 0

    def probabilities(self, windows):
        self.asked += [w.replace("\1", "?") for w in windows]
        self.calls += 1
        return np.zeros(len(windows))


def test_windows_are_cut_from_many_texts_at_once(monkeypatch):
    rng = random.Random(23)
    texts = ["", "x", "abcdefgh", "naïve ünïcode wörds 漢字abcdef"] + [
        "".join(rng.choice("abcdefgh01 \u00e9/=") for _ in range(rng.randint(0, 900))) + "a" * rng.choice([0, 5, 49, 200])
        for _ in range(60)]
    want = [secret_scan.window(t, s, e) for t in texts for a, b in secret_scan.uncovered(t, secret_scan.base_spans(t))
            for s, e in secret_scan.slices(a, b)]
    want = ["".join(c if c < "\x80" else "?" for c in w) for w in want]
    seen = {}
    for at_once in (8192, 50, 1):
        monkeypatch.setattr(secret_scan, "_AT_ONCE", at_once)
        seen[at_once] = Listening()
        secret_scan.scan_texts(texts, seen[at_once])
        assert seen[at_once].asked == want
    # Texts share a call, and a text beyond the bound is judged in several.
    assert seen[8192].calls == 1 < seen[50].calls < seen[1].calls
