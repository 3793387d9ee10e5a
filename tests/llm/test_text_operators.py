"""Quality counts, secrets, personal data, shards and packing against plain definitions."""

import random
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from tables import SF, documents, sf_dir  # noqa: F401

from commerce_lake.llm import packing, pii, quality, queries, secret_scan, shards

rng = random.Random(5)
SCRAPS = [
    "a@b.c", "@", "a@b@c.de", "x.y+z@mail-1.example.com.", "1.2.3.4", "256.1.1.1.1.2", "0001.2.3.4.5.6.7.8", ".1.2..3",
    "4539 1488-0343 6467", "4539148803436467", "1234567890123456", "+1 (403) 555-9312", "+12", "++49 30 1234567", "+1.2.3.4.5.6.7.8",
    "http://u@h.example/x?y=1).", "HTTPS://a.b", "://", "account no: 12-3456-789 and", "IBAN: DE89 3704 0044 0532 0130 00 x",
    "password=abc", "Password : 'hunter22'", "api_key=\"A1b2C3d4\"", "APIKEY==", "tokentoken:abcdef", "secret = secret = abcdefgh",
    "AKIA" + "Q" * 15, "AKIA" + "Q" * 16, "0123456789abcdef01234567", "deadbeef" * 4, "ghp_" + "a1" * 18, "ſecret=abcdefg",
    "é", "word", " ", "\n", "\t", "-", ".", "9", "0", "Æ@ø.dk", "\x1c", " ",
]
TEXTS = [None, "", " ", "\n\n", "🙂" * 30 + "a@b.cd", "a" * 4000, "@" * 5000, "1." * 5000, "9" * 3000, "+1 " * 3000, "\u0000"]
TEXTS += ["".join(rng.choices(SCRAPS, k=rng.randint(1, 25))) for _ in range(1500)]
TEXTS += ["word next line\n" * 40, "word next line\n" * 40, "one two three four\n" * 3]


def test_personal_data_matches_the_patterns(documents):
    rows = pii.find(documents(TEXTS), spans="found").collect()
    assert len(rows) == len(TEXTS)
    kinds = set()
    for row in rows:
        spans = [(s["kind"], s["start"], s["end"]) for s in row["found"]]
        kinds |= {k for k, _, _ in spans}
        assert [s for s in spans if s[0] in pii.BASE_KINDS] == brute.personal(TEXTS[row["doc_id"]])
        assert spans == sorted(spans, key=lambda s: (pii.KINDS.index(s[0]), s[1]))
    assert kinds == set(pii.KINDS)


def test_account_numbers_are_validated():
    a = pii.automaton()
    found = lambda t: [t[s:e] for k, s, e in pii.spans_of(t, a) if k == "account"]
    assert found("IBAN: DE89 3704 0044 0532 0130 00 thanks") == ["DE89 3704 0044 0532 0130 00"]
    assert found("iban DE88 3704 0044 0532 0130 00") == []
    assert found("Account No: 1234-5678 is") == ["1234-5678"]
    assert found("account of the holder") == []


def test_schemes_and_cues_in_any_casing():
    a = pii.automaton()
    found = lambda t: [(k, t[s:e]) for k, s, e in pii.spans_of(t, a) if k in ("url", "account")]
    for lead in ("", "İ🙂ẞ "):  # lower() would change the length of the first
        assert found(f"{lead}Http://user:pw@host/x") == [("url", "Http://user:pw@host/x")]
        assert found(f"{lead}hTTpS://A.b/C ok") == [("url", "hTTpS://A.b/C")]
        assert found(f"{lead}aCCount no: 1234-5678 is") == [("account", "1234-5678")]
    assert pii.folded("AbZİẞ") == "abzİẞ"


def test_secrets_match_the_patterns(documents):
    rows = secret_scan.find(documents(TEXTS), spans="found").collect()
    base = {r.kind for r in secret_scan.BASE_RULES}
    for row in rows:
        spans = [(s["kind"], s["start"], s["end"]) for s in row["found"]]
        assert [s for s in spans if s[0] in base] == brute.secrets(TEXTS[row["doc_id"]])


def test_trigram_queries():
    derived = {r.kind: secret_scan.derive(r) for r in secret_scan.RULES}
    assert derived["hex"] == []  # scanned in full
    assert derived["access"] == [(frozenset({b"aki", b"kia"}),)]
    options = derived["assign"][0]
    assert frozenset({b"tok", b"oke", b"ken"}) in options and len(options) == 6
    assert secret_scan.derive(secret_scan.Rule("x", r"(abc|de)f*")) == []
    assert secret_scan.derive(secret_scan.Rule("x", r"(?:ab|cd)x?yz")) == [
        (frozenset({b"abx", b"bxy", b"xyz"}), frozenset({b"aby", b"byz"}), frozenset({b"cdx", b"dxy", b"xyz"}), frozenset({b"cdy", b"dyz"}))
    ]


@pytest.mark.parametrize("pattern", [r"(abc|def){2}x", r"a(b|c)+def", r"[ab]cd?efg", r"(?:x|yz)abc\d+end", r"héllo", r"ab(?=cde)cde"])
def test_no_candidate_is_lost(pattern):
    rule = secret_scan.Rule("r", pattern)
    texts = ["".join(rng.choices(["abc", "def", "x", "a", "b", "cd", "efg", "yz", "1", "end", "HÉLLO", "héllo"], k=8)) for _ in range(2000)]
    found = secret_scan.make_scanner((rule,))(texts)
    import re

    assert [[(a, e) for a, _, _, e in f] for f in found] == [[m.span() for m in re.finditer(pattern, t)] for t in texts]


def test_redaction(spark, documents):
    from pyspark.sql import functions as F

    texts = ["x AKIA" + "A" * 16 + " y", "plain", "", "token=abcdefgh" + "0" * 30 + " 🙂 secret: abcdefgh!", None]
    found = secret_scan.find(documents(texts, extra=False))
    out = {r["doc_id"]: r["t"] for r in found.select("doc_id", secret_scan.redacted(F.col("text"), F.col("spans"), "#").alias("t")).collect()}
    assert out == {0: "x # y", 1: "plain", 2: "", 3: "# 🙂 #!", 4: None}


def test_quality_counts(documents):
    rows = quality.measured(documents(TEXTS)).collect()
    for row in rows:
        expected = brute.quality(TEXTS[row["doc_id"]])
        assert {k: row[k] for k in expected if k != "base_failed"} == {k: v for k, v in expected.items() if k != "base_failed"}


def test_quality_verdicts(spark, documents):
    good = [" ".join(rng.choices(["alpha", "beta", "gamma", "delta", "eps", "zeta", "of", "the"], k=400)) for _ in range(300)]
    good = [t for t in good if not brute.quality(t)["base_failed"]]
    good = [" ".join(f"w{rng.randint(0, 5000)}" for _ in range(rng.randint(60, 400))) for _ in range(300)]
    junk = [t.replace(" ", "$$ ") for t in good[:20]]
    docs = documents([*good, *junk, None, "short"])
    counts = quality.measured(docs)
    judged = {r["doc_id"]: r["kept"] for r in quality.judge(counts, quality.fences(counts)).collect()}
    assert all(judged[i] for i in range(len(good)))
    assert not any(judged[i] for i in range(len(good), len(docs.collect())))


def test_quality_null_groups_and_empty(spark, documents):
    text = " ".join(f"w{i}" for i in range(80))
    rows = [(1, text, None, None, 1), (1, text, None, None, 1), (None, text, "en", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    counts = quality.measured(df)
    assert [r["kept"] for r in quality.judge(counts, quality.fences(counts)).collect()] == [True] * 3
    none = quality.measured(df.limit(0))
    assert quality.judge(none, quality.fences(none)).collect() == []


def _prose_and(spark, *sources):
    """Rows like `measured` gives: 10000 documents of prose without symbols and,
    of each (name, n, symbols), n documents of 100 words."""
    rows = [(0, "en", "prose")] * 10000 + [(symbols, "en", name) for name, n, symbols in sources for _ in range(n)]
    return spark.createDataFrame(
        [(i, lang, name, 100, 500, symbols, 1, 0, 0) for i, (symbols, lang, name) in enumerate(rows)],
        "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, n_lines long, "
        "n_dup_lines long, n_repeat_words long",
    )


def test_small_sources_have_limits_of_their_own(spark):
    """A source of unusual style is judged alike just below and above any size."""
    counts = _prose_and(spark, ("code150", 150, 40), ("code199", 199, 40), ("code200", 200, 40), ("few", 3, 40))
    kept = Counter(r["source"] for r in quality.judge(counts, quality.fences(counts)).filter("kept").collect())
    assert kept == {"prose": 10000, "code150": 150, "code199": 199, "code200": 200}  # three are no evidence


def test_repetition_has_a_fence_below_the_base_rule(spark):
    """0.45 is unusual in prose, usual in verse; what fails the base rules moves no fence."""
    shares = [("prose", share, n) for share, n in ((0, 280), (2, 19), (45, 1), (95, 40))]
    shares += [("verse", share, n) for share, n in ((0, 20), (30, 150), (45, 130))]
    rows = [(source, 500, 2500, 0, 1, 0, 5 * share) for source, share, n in shares for _ in range(n)]
    counts = spark.createDataFrame(
        [("en", *row) for row in rows],
        "lang string, source string, n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long",
    )
    judged = quality.judge(counts, quality.fences(counts)).filter("kept").collect()
    kept = Counter((r["source"], r["n_repeat_words"] // 5) for r in judged)
    assert kept == {(source, share): n for source, share, n in shares if (source, share) not in {("prose", 45), ("prose", 95)}}


def test_priors_have_fixed_weight_and_even_ranks(spark):
    schema = "lang string, metric string, bucket int, n long"
    coarse = spark.createDataFrame([("en", "m", None, 500), ("en", "m", 1, 300), ("en", "m", 2, 200), (None, "m", 7, 3)], schema)
    thin = {(r["lang"], r["bucket"]): r["n"] for r in quality.thinned(coarse, 10, "lang").collect()}
    assert thin == {("en", None): 5, ("en", 1): 3, ("en", 2): 2, (None, 7): 10}
    fine = spark.createDataFrame([("en", "a", "m", 1, 4), (None, None, "m", 9, 1)], "lang string, source string, metric string, bucket int, n long")
    rows = quality.with_prior(fine, coarse, 10, ("lang", "source"), ("lang",)).collect()
    assert {(r["lang"], r["source"], r["bucket"]): r["n"] for r in rows} == {
        ("en", "a", None): 5, ("en", "a", 1): 7, ("en", "a", 2): 2, (None, None, 7): 10, (None, None, 9): 1,
    }


def test_labelled_documents_are_judged_as_labelled(spark):
    folder = "/root/testdata/sf0.1"
    judged = queries.op4_quality_rules(spark, folder).filter("NOT base_failed").select("doc_id", "kept")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    kept = {(r["quality"], r["kept"]) for r in judged.join(labels, "doc_id").distinct().select("quality", "kept").collect()}
    assert kept == {(0, False), (1, True)}


def test_sketch_quantiles_are_close(spark):
    values = [float(x) for x in np.random.RandomState(0).lognormal(0, 1, 5000)]
    counts = spark.createDataFrame(
        [("en", "s", 1000, int(1000 * v), 0, 1, 0, 0) for v in values],
        "lang string, source string, n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long",
    )
    row = quality.quantiles(quality.sketches(counts), "lang", "source").filter("metric = 'mean_word_chars'").collect()[0]
    exact = np.quantile([int(1000 * v) / 1000 for v in values], [0.25, 0.5, 0.75], method="inverted_cdf")
    assert np.allclose([row["low"], row["middle"], row["high"]], exact, rtol=0.0101)


@pytest.mark.parametrize("n", [1, 2, 3, 40, 41, 1000, 4096, 4097])
def test_feistel_is_a_permutation(n):
    image = shards.permute(np.arange(n), n, 7)
    assert sorted(image.tolist()) == list(range(n))
    if n == 1000:
        assert abs(np.corrcoef(image, np.arange(n))[0, 1]) < 0.1


def test_feistel_scalar():
    """The vectors against a scalar walk with Python integers."""
    n, seed, m64 = 1000, 20, 2**64 - 1
    bits, keys = shards.half_bits(n), shards.round_keys(seed)

    def once(x):
        left, right = x >> bits, x & ((1 << bits) - 1)
        for key in keys:
            v = (right + key) * 0x9E3779B97F4A7C15 & m64
            v = (v ^ (v >> 29)) * 0xBF58476D1CE4E5B9 & m64
            left, right = right, left ^ ((v >> 32) & ((1 << bits) - 1))
        return left << bits | right

    def walk(x):
        x = once(x)
        while x >= n:
            x = once(x)
        return x

    assert shards.permute(np.arange(n), n, seed).tolist() == [walk(i) for i in range(n)]


def test_shards(spark, documents, sf_dir):
    texts = [*TEXTS[:500], *["same"] * 700]
    docs = documents(texts).unionByName(documents(texts[:3]).selectExpr("NULL AS doc_id", "* EXCEPT (doc_id)"))
    rows = queries.op8_feistel_shards(spark, sf_dir(documents=docs)).collect()
    assert len(rows) == 1203
    by_shard = defaultdict(list)
    for r in rows:
        by_shard[r["shard"]].append(r["slot"])
        if r["doc_id"] is not None:
            data = (texts[r["doc_id"]] or "").encode()
            assert (r["size"], r["text_crc32"]) == (len(data) + 16, zlib.crc32(data))
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    counts = Counter(map(len, by_shard.values()))
    assert len(by_shard) == 40 and set(counts) <= {30, 31}
    again = queries.op8_feistel_shards(spark, sf_dir(documents=docs.repartition(7))).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again))  # whatever way the rows come


def test_shards_of_nothing(spark, documents):
    assert shards.assign(documents(["x"]).limit(0), 40).collect() == []


def test_encoder_matches_the_library():
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    encoder = packing.Encoder(path)
    texts = [t or "" for t in TEXTS[:900]] + ["<|endoftext|> it's we'll  two\n\n three ", "x  y"]
    for text in texts:
        ids = encoder.ids(text)
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids
        assert encoder.text(ids) == text


def test_added_tokens_are_matched_as_the_library_does(monkeypatch):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    library, encoder = Tokenizer.from_file(path), packing.Encoder(path, added=True)
    end, draw = "<|endoftext|>", random.Random(7)
    assert encoder.ids(f"a {end} b").tolist() == [64, 220, 50256, 275]
    parts = [end, end, "a b", " ", "  ", "\n", "<|", "|>", "endoftext", "it's", "é", "🙂", "x1 "]
    texts = ["", end, f"{end}{end}", f"  {end}  y", *["".join(draw.choices(parts, k=draw.randint(1, 30))) for _ in range(500)]]
    for stretch in (packing.STRETCH, 3):
        monkeypatch.setattr(packing, "STRETCH", stretch)
        for text in [*texts, *[t or "" for t in TEXTS[:300]]]:
            ids = encoder.ids(text)
            assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
            assert encoder.text(ids) == text


def test_added_tokens_take_their_whole_string_only(tmp_path):
    import json

    with open(queries.tokenizer_path(), encoding="utf-8") as file:
        whole = json.load(file)
    whole["added_tokens"][0]["lstrip"] = True
    (tmp_path / "t.json").write_text(json.dumps(whole), encoding="utf-8")
    with pytest.raises(ValueError, match="added tokens"):
        packing.Encoder(str(tmp_path / "t.json"), added=True)


def test_packed_ids_are_the_librarys(spark, sf_dir, documents):
    from tokenizers import Tokenizer

    texts = ["a <|endoftext|> b", "<|endoftext|>" * 3, "plain words", None]
    library = Tokenizer.from_file(queries.tokenizer_path())
    expected = {i: [*library.encode(t or "", add_special_tokens=False).ids, 0] for i, t in enumerate(texts)}
    for r in queries.op10_vector_packing(spark, sf_dir(documents=documents(texts, extra=False))).collect():
        ids = expected[r["doc_id"]]
        assert (r["start"], r["length"], r["doc_tokens"]) == (0, len(ids), len(ids))
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())


def test_long_texts_are_cut_where_tokens_end(monkeypatch):
    text = " ".join(rng.choices(["don't", "ab", "  ", "\n", "x1", "é", "longer", "."], k=3000))
    encoder = packing.Encoder(queries.tokenizer_path())
    whole = encoder.ids(text).tolist()
    monkeypatch.setattr(packing, "STRETCH", 50)
    assert encoder.ids(text).tolist() == whole


def test_packing(spark, documents, sf_dir):
    texts = [t for t in TEXTS if t is None or len(t) < 100_000]
    docs = documents(texts)
    rows = packing.place(docs, queries.tokenizer_path(), limits=packing.Limits(128, 5, 120)).collect()
    encoder = packing.Encoder(queries.tokenizer_path())
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert set(pieces) == set(range(len(texts)))
    for doc, parts in pieces.items():
        parts.sort(key=lambda r: r["start"])
        ids = np.concatenate([np.frombuffer(r["ids"], "<u4") for r in parts])
        assert ids.tolist() == [*encoder.ids(texts[doc] or "").tolist(), 0]
        assert [r["start"] for r in parts] == np.cumsum([0, *[r["length"] for r in parts[:-1]]]).tolist()
        assert {r["doc_tokens"] for r in parts} == {len(ids)}
    for placed in sequences.values():
        placed.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in placed] == np.cumsum([0, *[r["length"] for r in placed[:-1]]]).tolist()
        assert sum(r["length"] for r in placed) <= 128 and len(placed) <= 5 and sum(r["loss_tokens"] for r in placed) <= 120


def test_packing_pads_little(spark):
    rows = queries.op10_vector_packing(spark, "/root/testdata/sf0.01").toPandas()
    fill = rows["length"].sum() / (1024 * rows["sequence_id"].nunique())
    assert fill > 0.99


def test_batches_of_nothing(spark, documents):
    empty = documents(["x"], extra=False).limit(0)
    assert pii.find(empty).collect() == [] and secret_scan.find(empty).collect() == []
    assert packing.place(empty, queries.tokenizer_path()).collect() == []


@pytest.mark.parametrize("name", ["op7_secret_scan", "op9_personal_data", "op4_quality_rules"])
def test_queries_cover_the_whole_table(spark, name):
    rows = queries.QUERIES[name](spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    if name != "op4_quality_rules":
        texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
        plain = brute.secrets if name.startswith("op7") else brute.personal
        assert {r["doc_id"]: r["base_sha256"] for r in rows} == {i: brute.sha(brute.joined(plain(t))) for i, t in texts.items()}
