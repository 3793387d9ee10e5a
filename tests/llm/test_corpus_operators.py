"""Links, containment, language model, chat trees, archives and the pipeline against plain definitions."""

import gzip
import json
import math
import random
import zlib
from collections import Counter, defaultdict
from html.parser import HTMLParser
from pathlib import Path

import brute
import numpy as np
import pyarrow as pa
import pytest
from tables import SF, documents, sf_dir  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline
from commerce_lake.llm import chat, common, components, decontam, lm, neardup, packing, quality, queries, warc

rng = random.Random(9)
WORDS = [f"w{i}" for i in range(300)]


def _edited(words: list[str], share: float) -> str:
    return " ".join(rng.choice(WORDS) if rng.random() < share else w for w in words)


def _copies() -> list:
    """Copies, near-copies at many distances of a common text, and strangers."""
    base = rng.choices(WORDS, k=120)
    texts = [_edited(base, rng.choice([0, 0.01, 0.03, 0.06, 0.09])) for _ in range(220)]
    chain = rng.choices(WORDS, k=100)
    for _ in range(25):  # neighbours are similar, the ends are not
        chain = chain[5:] + rng.choices(WORDS, k=5)
        texts.append(" ".join(chain))
    texts += [" ".join(rng.choices(WORDS, k=rng.randint(1, 90))) for _ in range(100)]
    return [*texts, None, "", " \n", "one", "ONE", "one two", "One  two", "É é", "é é", *texts[:40]]


@pytest.mark.parametrize("size", [2, 5])
def test_links_lose_nothing(spark, documents, size):
    texts = _copies()
    plan = neardup.Plan(words=size, hubs=1, block=16)
    rows = neardup.link(documents(texts), plan).collect()
    expected = brute.components(dict(enumerate(texts)), size)
    assert {r["doc_id"]: r["component_id"] for r in rows} == expected
    assert all(r["n_shingles"] == len(brute.shingles(texts[r["doc_id"]], size)) for r in rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


def test_links_of_awkward_rows(spark):
    df = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (4, "a b c"), (4, "a b c"), (2, "a b c"), (9, "")], "doc_id long, text string")
    rows = Counter((r["doc_id"], r["component_id"], r["kept"]) for r in neardup.link(df, neardup.Plan(words=2)).collect())
    assert rows == {(None, None, True): 2, (4, 2, False): 2, (2, 2, True): 1, (9, 9, True): 1}
    assert neardup.link(df.limit(0)).collect() == []


def test_circulant_signature_estimates_similarity():
    signer = neardup.Signer(neardup.Plan())
    a, b = np.arange(0, 9000, dtype=np.int64) * 7919, np.arange(1000, 10000, dtype=np.int64) * 7919
    assert abs((signer.sign(a) == signer.sign(b)).mean() - 0.8) < 0.1


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(1000, 1400)] + [(5, 5)]
    found = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {**{i: 100 for i in range(101, 161)}, **{i: 7 for i in range(1000, 1400)}}


def test_containment(spark, documents):
    item = lambda n: " ".join(rng.choices(WORDS, k=n))
    items = [(1, item(30)), (2, item(10)), (3, item(9)), (4, "Zz9"), (5, "zz9"), (6, None), (7, "--"), (None, item(12)), (8, "w1 w1 w1 w1 w1 w1 w1 w1 w1 w1 w1"), (10, item(3))]
    items.append((9, items[0][1]))
    texts = [None, "", "w1 " * 40]
    for _ in range(150):
        parts = [item(rng.randint(0, 30))]
        for _, text in rng.choices(items, k=2):
            words = (text or "").split()
            a = rng.randint(0, max(0, len(words) - 10))
            parts += [",".join(words[a : a + rng.choice([3, 9, 10, 12])]).upper(), item(rng.randint(0, 4))]
        texts.append(" ".join(parts))
    docs = documents(texts)
    found = decontam.find(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    expected = brute.containment(dict(enumerate(texts)), items)
    for r in found:
        n_words, n_hit, n_items, ids = expected[r["doc_id"]]
        assert (r["n_words"], r["n_hit"], r["n_items"]) == (n_words, n_hit, n_items)
        assert r["item_ids"] == [i for i in ids if i != "None"]
    assert sum(r["n_hit"] > 0 for r in found) > 50
    twice = docs.filter("doc_id < 9").union(docs.filter("doc_id < 9"))
    assert len(decontam.find(twice, spark.createDataFrame(items, "item_id long, text string")).collect()) == 18
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r["n_hit"] for r in decontam.find(docs, none).collect()} == {0}
    assert decontam.find(docs.limit(0), none).collect() == []


def test_containment_tells_rows_of_one_id_apart(spark):
    leak = " ".join(WORDS[:12])
    rows = [(1, leak), (1, "clean words only"), (1, leak), (None, leak), (None, "clean"), (2, None), (2, f"{leak} {leak}")]
    items = spark.createDataFrame([(7, leak)], "item_id long, text string")
    found = decontam.find_in_rows(spark.createDataFrame(rows, "doc_id long, text string"), items)
    assert found.columns == ["doc_id", "n_words", "n_hit", "n_items", "item_ids"]
    assert Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["item_ids"])) for r in found.collect()) == Counter({
        (1, 12, 12, ("7",)): 2, (1, 3, 0, ()): 1, (None, 12, 12, ("7",)): 1, (None, 1, 0, ()): 1, (2, 0, 0, ()): 1, (2, 24, 24, ("7",)): 1,
    })


def test_containment_runs_no_python(spark):
    plan = decontam.find_in_rows(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet"))
    text = plan._jdf.queryExecution().toString()
    assert "Python" not in text and "Arrow" not in text and "CartesianProduct" not in text


def _model(texts: dict, plan: lm.Plan):
    """Scores by dictionaries: doc_id -> (n_tokens, n_known, base, score), and N."""
    tokens = {i: [*brute.words_of(t), " "] for i, t in texts.items()}
    fold = {i: zlib.crc32(str(i).encode()) % plan.folds for i in texts}

    def runs(i):
        """For each token its runs of one to `order` tokens, shorter where the text begins."""
        padded = [" ", *tokens[i]]
        return [tuple(tuple(padded[max(at - k, 0) : at + 1]) for k in range(plan.order)) for at in range(1, len(padded))]

    def count(chosen):
        counts = Counter()
        for i in chosen:
            for each in runs(i):
                counts.update(set(each))  # a run that is cut short is that of an order below
        words = [c for run, c in counts.items() if len(run) == 1]
        return counts, sum(words), len(words)

    def estimates(each, counts, n, v):
        """(bucket, estimates from the highest order to zero) of one token."""
        contexts = [counts[run[:-1]] for run in each[1:]]
        bucket = max(((k, c.bit_length()) for k, c in enumerate(contexts) if c), default=0)
        of = [counts[run] / max(c, 1) for run, c in zip(each[1:], contexts, strict=True)]
        return bucket, [*reversed(of), counts[each[0]] / max(n, 1), 1 / (v + 1)]

    width = plan.order + 1
    model = count([i for i in texts if fold[i] not in (plan.test, plan.held)])
    events = Counter(each for i in texts if fold[i] == plan.held for each in runs(i))
    weights = defaultdict(lambda: [1 / width] * width)
    for _ in range(plan.rounds):
        sums = defaultdict(lambda: [1 / 3] * width)
        for each, times in events.items():
            b, f = estimates(each, *model)
            parts = [a * x for a, x in zip(weights[b], f, strict=True)]
            for k in range(width):
                sums[b][k] += times * parts[k] / sum(parts)
        last = {b: weights[b] for b in sums}
        weights.update({b: [x / sum(s) for x in s] for b, s in sums.items()})
        if max((abs(x - y) for b in sums for x, y in zip(last[b], weights[b], strict=True)), default=0) < plan.settled:
            break
    one, n, v = model = count([i for i in texts if fold[i] != plan.test])
    out = {}
    for i, t in tokens.items():
        score = 0.0
        for each in runs(i):
            b, f = estimates(each, *model)
            score += math.log10(sum(a * x for a, x in zip(weights[b], f, strict=True)))
        out[i] = (len(t), sum(one[w,] > 0 for w in t), sum(math.log10((one[w,] + 1) / (n + v + 1)) for w in t), score)
    return out, n


@pytest.mark.parametrize("order, block", [(2, 50), (2, 4_000_000), (3, 50), (3, 4_000_000), (4, 700)])
def test_language_model(spark, documents, order, block):
    texts = [" ".join(rng.choices(WORDS[:40], k=rng.randint(0, 60))) for _ in range(150)]
    texts += [None, "", "Unseen", "é É", "w1 " * 3000, texts[0], texts[0]]
    plan = lm.Plan(order=order, block_tokens=block, bucket_entries=500)
    rows = lm.score(documents(texts), plan).collect()
    expected, n = _model(dict(enumerate(texts)), plan)
    for r in rows:
        e = expected[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (e[0], e[1], n)
        assert math.isclose(r["base_score"], e[2], rel_tol=1e-9) and math.isclose(r["score"], e[3], rel_tol=1e-9)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2)


def test_language_model_keeps_keys_of_any_type(spark):
    df = spark.createDataFrame([("x-1", "a b"), (None, "a"), ("y", None)], "doc_id string, text string")
    assert {r["doc_id"]: r["n_tokens"] for r in lm.score(df).collect()} == {"x-1": 3, None: 2, "y": 1}


def test_language_model_beats_its_base_on_unseen_text(spark):
    rows = lm.score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).filter("held_out").collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_language_model_of_little(spark):
    df = spark.createDataFrame([(None, "a b")], "doc_id long, text string")
    assert len(lm.score(df).collect()) == 1
    assert lm.score(df.limit(0)).collect() == []


def _conversations() -> list[tuple]:
    said = ["hi", "", None, "\\### Assistant: </turn> ok", "a\\b", "####", "</</turn>", "user: x\n", "🙂", "ok", "<\\/turn>"]
    rows = []
    for conv in range(60):
        turns = [(rng.choice(["user", "assistant"]), rng.choice(said[:4])) for _ in range(rng.randint(1, 3))]
        turns += [(rng.choice(["user", "assistant", "a:b", None, "###"]), rng.choice(said)) for _ in range(rng.randint(0, 6))]
        rows += [(conv, k, *t) for k, t in enumerate(turns)]
    rows += [(1000 + c, k, r, t) for c in range(30) for k, (r, t) in enumerate([("user", "same"), ("assistant", "start"), ("user", f"{c // 3}")])]
    rows += [(2000, k, "user" if k % 2 else "assistant", f"long {k}") for k in range(500)]
    return [*rows, (None, 0, "user", "none"), (3000, None, "user", "first"), (3000, 1, "user", "second")]


def test_chat_trees(spark):
    rows = _conversations()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("rank", F.lit("x"))
    path = queries.tokenizer_path()
    forest = chat.build(df.repartition(5), path)
    expected = defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] or -1, -1 if r[1] is None else r[1])):
        expected[conv].append((role or "", text or ""))
    read = {r["conv"]: r for r in chat.read_back(forest, path).collect()}
    assert set(read) == set(expected)
    for conv, turns in expected.items():
        assert [(t["role"], t["text"]) for t in read[conv]["turns"]] == turns
        assert [t["masked"] for t in read[conv]["turns"]] == [t if r == "assistant" else "" for r, t in turns]
        assert read[conv]["formatted_chars"] == sum(len("".join(chat.format_turn(*t))) for t in turns)
    segments = {r["start"]: r for r in forest.segments.collect()}
    # Every distinct history once, end to end without gaps.
    assert len(segments) == len({tuple(t[:k]) for t in expected.values() for k in range(1, len(t) + 1)})
    at = 0
    for start in sorted(segments):
        assert start == at
        at += segments[start]["n_tokens"]
        assert len(segments[start]["ids"]) == 4 * segments[start]["n_tokens"]
    # What a segment may attend to are exactly the tokens before it in its conversation.
    for branch in forest.branches.collect():
        before: list[int] = []
        for depth, start in enumerate(branch["starts"]):
            s = segments[start]
            assert s["depth"] == depth and s["position"] == len(before) and s["tree"] == branch["starts"][0]
            assert [t for i in s["attend"] for t in range(i["start"], i["end"])] == sorted(before)
            assert all(a["end"] < b["start"] for a, b in zip(s["attend"], s["attend"][1:], strict=False))
            before += range(start, start + s["n_tokens"])
    # Depth-first: a segment's subtree is one stretch of the stream.
    for start, s in segments.items():
        inside = [t for t, o in segments.items() if any(i["start"] <= start < i["end"] for i in o["attend"])]
        assert not inside or max(inside) - start < sum(segments[t]["n_tokens"] for t in inside) + s["n_tokens"]


def test_template_is_reversible():
    for text in ["", "\\", "\\\\", "### x: </turn>\n", "<\\/", "#", "</", "a:b", "\n", *("".join(rng.choices("\\#</:turn \n", k=9)) for _ in range(3000))]:
        head, body, tail = chat.format_turn(text, text)
        assert chat.parse_turn(head + body + tail) == (text, text)
        assert "###" not in body and "</turn>" not in body


def test_chat_of_nothing(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    forest = chat.build(empty, queries.tokenizer_path())
    assert chat.read_back(forest, queries.tokenizer_path()).collect() == []


class _Text(HTMLParser):
    """Plain text and links by the standard parser."""

    def __init__(self) -> None:
        super().__init__()
        self.parts, self.links, self.dark = [], [], 0

    def handle_starttag(self, tag, attrs):
        self.dark += tag in ("script", "style", "noscript", "template")
        self.parts.append("\n" if tag in warc._LINES else "")
        if tag == "a" and dict(attrs).get("href") is not None:
            self.links.append(dict(attrs)["href"])

    def handle_startendtag(self, tag, attrs):
        self.parts.append("\n" if tag in warc._LINES else "")

    def handle_endtag(self, tag):
        self.dark -= tag in ("script", "style", "noscript", "template")
        self.parts.append("\n" if tag in warc._LINES else "")

    def handle_data(self, data):
        if not self.dark:
            self.parts.append(data.replace("\n", " "))


def _parsed(page: str) -> tuple[str, list[str]]:
    parser = _Text()
    parser.feed(page)
    parser.close()
    lines = (" ".join(line.split()) for line in "".join(parser.parts).split("\n"))
    return "\n".join(line for line in lines if line), parser.links


def test_plain_text_equals_the_standard_parser(spark):
    for row in spark.read.parquet(f"{SF}/pages.parquet").collect():
        text, links = _parsed(row["html"] or "")
        lines = (" ".join(line.split()) for line in warc.Page(row["html"] or "").text.split("\n"))
        assert "\n".join(lines) == text


def test_made_up_pages_equal_the_standard_parser():
    """Quoted values with any character, links and tags where none counts, titles and languages."""
    pick = random.Random(4)
    inside = ["x", "1>0", "a<b", "</p>", "<a href=q>", "it's", "?a=1&amp;b=2", " ", "é", "-->"]
    attribute = lambda: pick.choice(
        [f'title="{pick.choice(inside)}"', f"data-x = '{pick.choice([i for i in inside if chr(39) not in i])}'", "hidden", "class=a/b"]
    )
    link = lambda: f"<a {attribute()} href={pick.choice(['u', chr(34) + pick.choice(inside) + chr(34), chr(39) + '/p?q' + chr(39)])} {attribute()}>"
    for _ in range(400):
        parts = []
        for _ in range(pick.randint(1, 25)):
            parts.append(pick.choice([
                link, lambda: "</a>", lambda: f"<p {attribute()}>", lambda: "</P>", lambda: f"<b {attribute()}>", lambda: "<br/>",
                lambda: "word ", lambda: "&lt;i&gt; &amp; ", lambda: "\n", lambda: "<!-- <a href='c'> <p> -->", lambda: "<!DOCTYPE html>",
                lambda: f"<script {attribute()}>var a = \"<a href='s'>\" < 3;</script>", lambda: "<style>p > a { }</style>",
            ])())
        page = "".join(parts)
        text, links = _parsed(page)
        read = warc.Page(page)
        assert "\n".join(" ".join(line.split()) for line in read.text.split("\n")) == text, page
        assert read.links == links, page
    read = warc.Page("<script>'<title>no</title>'</script><HTML data-lang=xx LANG='pt-BR'><title lang=de>A &lt; B\n</title><title>C</title>")
    assert (read.title, read.language, read.text) == ("A < B", "pt-br", "A < B\nC")


@pytest.mark.parametrize("piece", ['<a href="', '<p "', "<", "<!--", "<script>", "</", '<a x="1" ', "<a '><b \""])
def test_broken_pages_end(piece):
    read = warc.Page(piece * 20_000)
    assert len(read.text) <= len(piece) * 20_000


def _records(data: bytes) -> list[tuple[dict, bytes]]:
    out = []
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        version, *lines = head.decode().split("\r\n")
        assert version == "WARC/1.1"
        headers = dict(line.split(": ", 1) for line in lines)
        n = int(headers["Content-Length"])
        assert rest[n : n + 4] == b"\r\n\r\n"
        out.append((headers, rest[:n]))
        data = rest[n + 4 :]
    return out


def test_archive_round_trip(spark, tmp_path):
    pages = [(1, "http://a.example/", "<html lang='EN'><title>T &amp; U</title><p>one<p>two\r\n\r\nthree<a href='/x?a=1&amp;b=2'>l</a>"), (2, None, None), (3, "u", ""), (1, "http://a.example/", "<p>é"), (4, "v", "<script>x"), (4, "v", "<script>x")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    responses = warc.responses(df)
    clashing = responses.withColumn("kind", F.lit("clash")).withColumn("record", F.lit(1)).withColumn("source_digest", F.lit(2)).withColumn("own", F.lit(3))
    derived = warc.derive(clashing)
    assert len(set(derived.columns)) == len(derived.columns) and derived.filter("own = 3 AND kind <> 'clash'").count() == 12
    warc.write(derived, f"{tmp_path}/out")
    found = [r for f in Path(f"{tmp_path}/out").glob("*.gz") for r in _records(gzip.decompress(f.read_bytes()))]
    assert len(found) == 12
    ids = {r["record_id"]: r for r in responses.collect()}
    texts = {h["WARC-Record-ID"]: b for h, b in found if h["WARC-Type"] == "conversion"}
    for headers, block in found:
        source = ids[headers["WARC-Refers-To"]]
        assert headers["WARC-Block-Digest"] == warc.digest(block)
        assert headers["X-Source-Payload-Digest"] == warc.digest((source["payload"] or "").encode())
        assert headers.get("WARC-Target-URI") == source["target_uri"]
        if headers["WARC-Type"] == "metadata":
            body = json.loads(block)
            assert body["source"]["WARC-Record-ID"] == headers["WARC-Refers-To"]
            assert body["http"]["headers"]["Content-Length"] == str(len((source["payload"] or "").encode()))
            assert len(texts[headers["WARC-Concurrent-To"]].decode()) == body["text"]["characters"]
    first = next(json.loads(b) for h, b in found if h["WARC-Type"] == "metadata" and b"T & U" in b)
    assert first["html"] == {"title": "T & U", "language": "en", "links": ["/x?a=1&b=2"]}
    assert warc.derive(warc.responses(df.limit(0))).collect() == []


def test_archive_query(spark):
    rows = queries.op2_warc_derivatives(spark, SF).collect()
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert len(rows) == 2 * len(pages)
    for r in rows:
        assert r["source_digest"] == warc.digest(pages[r["page_id"]].encode())
        if r["kind"] == "conversion":
            assert r["block_digest"] == warc.digest(warc.Page(pages[r["page_id"]]).text.encode())


@pytest.fixture(scope="module")
def stages(spark):
    """(input, output) of every stage over a whole small table."""
    sf = "/root/testdata/sf0.01"
    docs, out = spark.read.parquet(f"{sf}/documents.parquet").cache(), {}
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, sf).cache()
        out[name] = ({r["doc_id"]: r for r in docs.collect()}, result.collect())
        docs = result
    return out


def test_stage_quality(stages):
    before, after = stages["quality_rules"]
    kept = {r["doc_id"] for r in after}
    failed = {i for i, r in before.items() if brute.quality(r["text"])["base_failed"]}
    assert not kept & failed
    symbols = {i for i, r in before.items() if i not in failed and brute.quality(r["text"])["n_symbols"] > 0.2 * brute.quality(r["text"])["n_words"]}
    assert not kept & symbols and len(kept) >= 0.98 * (len(before) - len(failed | symbols))
    assert all(before[r["doc_id"]] == r for r in after)


def test_stage_near_duplicates(stages):
    before, after = stages["near_duplicates"]
    expected = brute.components({i: r["text"] for i, r in before.items()}, 5)
    assert {r["doc_id"] for r in after} == {i for i, c in expected.items() if i == c}


def test_stage_decontamination(spark, stages):
    before, after = stages["benchmark_decontamination"]
    items = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").select("item_id", "text").collect()]
    expected = brute.containment({i: r["text"] for i, r in before.items()}, items)
    assert {r["doc_id"] for r in after} == {i for i, e in expected.items() if e[1] == 0}


def test_stage_secrets(stages):
    before, after = stages["secret_redaction"]
    assert {r["doc_id"] for r in after} == set(before)
    for r in after:
        text = before[r["doc_id"]]["text"]
        if brute.secrets(text):
            assert corpus_pipeline.SECRET_MARK in r["text"] and r["n_chars"] == len(r["text"])
        assert not brute.secrets(r["text"])


def test_stage_packing(stages):
    before, after = stages["packed_sequences"]
    total = Counter()
    for r in after:
        total[r["sequence_id"]] += r["length"]
    assert {r["doc_id"] for r in after} == set(before) and max(total.values()) <= 1024


def test_pipeline_run(spark, stages):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.01")
    assert {r["doc_id"] for r in rows.select("doc_id").distinct().collect()} == set(stages["packed_sequences"][0])


def test_pipeline_of_nothing_and_extra_columns(spark, sf_dir, documents):
    docs = documents(["x"])
    for name in ("n_words", "kept", "copy", "leak", "_gone", "row", "hash", "w", "bits"):
        docs = docs.withColumn(name, F.lit("keep"))
    folder = sf_dir(documents=docs.limit(0), benchmark=spark.createDataFrame([], "item_id long, text string"))
    for source in (docs.limit(0), docs):
        rows = source
        for _, stage in corpus_pipeline.STAGES[:-1]:
            rows = stage(spark, rows, folder)
            assert rows.columns == docs.columns
            rows.collect()


def test_decontamination_judges_rows_of_one_id_each(spark, sf_dir):
    leak = " ".join(WORDS[:10])
    rows = [(1, f"a {leak}"), (1, "clean"), (None, f"{leak} b"), (None, "clean"), (None, None), (2, f"x {leak}"), (2, f"x {leak}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    folder = sf_dir(benchmark=spark.createDataFrame([(1, leak)], "item_id long, text string"))
    kept = corpus_pipeline.benchmark_decontamination(spark, docs, folder).collect()
    assert Counter(map(tuple, kept)) == Counter([(1, "clean"), (None, "clean"), (None, None)])


def test_whole_queries(spark):
    for name, query in queries.QUERIES.items():
        assert query(spark, SF).count() > 0, name


def test_near_duplicates_of_rows_that_share_an_id(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcd")
    rows = [(5, a, 0), (3, a, 1), (5, b, 2), (2, c, 3), (2, c, 4), (None, d, 5), (None, d, 6), (None, a, 7), (9, None, 8), (9, None, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row long")
    kept = corpus_pipeline.near_duplicates(spark, docs, None)
    assert kept.columns == docs.columns
    kept = [tuple(r) for r in kept.collect()]
    assert sorted(t or "" for _, t, _ in kept) == ["", "", a, b, c, d]
    assert {(i, t) for i, t, _ in kept} == {(3, a), (5, b), (2, c), (None, d), (9, None)}
    assert len({n for *_, n in kept}) == 6


def _batches(monkeypatch, spark, make, rows):
    """Sizes of the batches that a function over Arrow batches hands on for one batch of `rows` texts."""
    docs = spark.createDataFrame([], "doc_id long, text string")
    runs = []
    with monkeypatch.context() as patch:
        patch.setattr(type(docs), "mapInArrow", lambda df, run, schema: runs.append(run))
        make(docs)
    monkeypatch.setattr(packing.TaskContext, "get", lambda: type("Task", (), {"partitionId": lambda self: 0})())
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(rows)), "text": [f"text {k}" for k in range(rows)]})
    return list(runs[0](iter([batch])))


def test_packing_hands_on_few_pieces_at_a_time(spark, monkeypatch):
    made = _batches(monkeypatch, spark, lambda docs: packing.place(docs, queries.tokenizer_path()), 3000)
    assert max(b.num_rows for b in made) <= packing.PIECES_AT_ONCE
    assert sorted(k for b in made for k in b.column("doc_id").to_pylist()) == list(range(3000))


def test_text_columns_are_made_for_few_texts_at_a_time(spark, monkeypatch):
    made = _batches(monkeypatch, spark, quality.measured, 5000)
    assert max(b.num_rows for b in made) <= common.TEXTS_AT_ONCE
    assert [k for b in made for k in b.column("doc_id").to_pylist()] == list(range(5000))
    assert [b.num_rows for b in _batches(monkeypatch, spark, quality.measured, 0)] == [0]
