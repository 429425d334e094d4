"""The operators against brute force, exact round trips and hand-made edge cases."""

from __future__ import annotations

import os
import random
import sys
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from costframe.llm import chat, decontaminate, exact_dedup, lm_scores, mixing, near_dedup, quality, registry, sharding, token_counts, warc  # noqa: E402
from costframe.llm.common import scratch_path, table  # noqa: E402

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "benchmark", "labels", "conversations")
DOCS = "doc_id long, text string, source string, size int, shard string, name string, score double, key string, h long"
ROWS = [(1, "a  b c d e f", "x"), (2, "a b\tc d e f", "x"), (2, "a b\tc d e f", "x"), (None, "a b c d e f", None), (None, None, None),
        (5, "", "y"), (6, " \n ", "y"), (7, "é" * 3000 + " z", "y"), (8, "A B C D E F", ""), (9, "tiny", "x")]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, blanks, ties, repeated rows and columns with clashing names."""
    return spark.createDataFrame([(*r, 1, "s", "n", 0.5, "k", 3) for r in ROWS], DOCS)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def words_of(text):
    return (text or "").encode().split()


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(registry.SQL[name]).df()
    got = registry.QUERIES[name](spark, SF).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    key = list(want.columns)
    got, want = (d.sort_values(key).reset_index(drop=True)[sorted(want.columns)] for d in (got, want))
    assert len(got) == len(want)
    for c in want.columns:
        assert (got[c].astype(object).where(got[c].notna(), None) == want[c].astype(object).where(want[c].notna(), None)).where(
            want[c].notna() | got[c].notna(), True).all(), c


OPERATORS = {
    "scores": lm_scores.backoff_scores, "exact": exact_dedup.exact_dedup, "tokens": token_counts.token_counts,
    "near": near_dedup.near_dedup, "shards": sharding.sharded, "mix": mixing.mixture,
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_one_row_a_row_also_for_odd_and_empty_tables(odd, name):
    got = OPERATORS[name](odd)
    assert Counter(r.doc_id for r in got.select("doc_id").collect()) == Counter(r[0] for r in ROWS)
    empty = OPERATORS[name](odd.limit(0))
    assert empty.count() == 0 and empty.columns == got.columns


def test_exact_dedup_with_clashing_hashes(spark):
    texts = ["abcdefghij" * k + tail for k in (1, 2, 5) for tail in ("", "x", "yz")] * 2 + ["", None, " "]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in exact_dedup.exact_dedup(docs, 4, 8, lambda c: F.pmod(F.xxhash64(c), F.lit(2))).collect()}
    for i, t in enumerate(texts):
        same = [j for j, u in enumerate(texts) if (u or "") == (t or "")]
        assert (got[i].keep_id, got[i].group_size, got[i].kept) == (same[0], len(same), same[0] == i)


def test_token_counts_equal_the_library(spark):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(token_counts.tokenizer_path())
    texts = [r.text for r in table(spark, SF, "documents").select("text").limit(40).collect()]
    texts += ["<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|>", "it's we'LL 'stop", "日本語 ẞß İi é", " a b", "x" * 500, "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = [(i, len((t or "").encode()), len(model.encode(t or "", add_special_tokens=False).ids)) for i, t in enumerate(texts)]
    for chunk in (3, 101, 1 << 16):
        got = token_counts.token_counts(docs, limit=50, chunk_bytes=chunk).orderBy("doc_id").collect()
        assert [tuple(r)[:3] for r in got] == want
        assert all(r.over_limit == (r.n_tokens > 50) for r in got)


def library_counts(texts):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(token_counts.tokenizer_path())
    return [len(e.ids) for e in model.encode_batch_fast(texts, add_special_tokens=False)]


def odd_texts(n):
    rng = random.Random(5)
    signs = ["abcdefghijklmnopqrstuvwxyz", "etaoin srhld'", "ab", "éèüßñабвгд日本語 's't'll", "'srtlvmd!?. 09", "\n\t <>|/wendoftx", "a\u0301 \u00a0\u2028½١Σ"]
    return ["".join(rng.choice(s) for _ in range(rng.randint(0, 200))) for s in signs for _ in range(n)]


def test_transducer_equals_the_library_on_odd_texts():
    machine = token_counts.Tokens(token_counts.tokenizer_path())
    texts = odd_texts(40) + ["z" * 3000 + " y", "<|endoftext|>" * 3, "'", "don't'll"]
    want = library_counts(texts)
    for chunk in (1, 7, 64):
        assert machine.count(texts, chunk).tolist() == want


def test_transducer_table_starts_anew_when_full():
    machine = token_counts.Tokens(token_counts.tokenizer_path(), most=3)
    texts = odd_texts(3) + ["q" * 100 + "abc" * 30]
    assert machine.count(texts).tolist() == machine.count(texts).tolist() == library_counts(texts)
    assert len(machine.merger.keys) < 3000


def test_long_texts_are_cut_at_white_space_only(monkeypatch):
    texts = [" ".join(odd_texts(5)), "ab" * 500, "", "one two\tthree\nfour" * 20, " " * 300]
    assert all("".join(token_counts.pieces(t, 50)) == t for t in texts)
    assert all(p[0].isspace() for t in texts for p in list(token_counts.pieces(t, 50))[1:])
    want = library_counts(texts)
    monkeypatch.setattr(token_counts.pieces, "__defaults__", (50,))
    assert token_counts.Tokens(token_counts.tokenizer_path()).count(texts).tolist() == want


def test_tokens_stand_beside_each_other_as_the_merges_leave_them():
    merger = token_counts.compiled(token_counts.tokenizer_path()).merger
    rng = random.Random(3)
    inner = [t for t, s in enumerate(merger.spelt) if s[-1] < 256]
    for _ in range(3000):
        a, b = rng.choice(inner), rng.randrange(len(merger.spelt))
        assert merger.stands(a, b) == (merger.merged([*merger.spelt[a], *merger.spelt[b]]) == [a, b])


def test_splitter_scan_equals_stepping():
    elements, product = token_counts.monoid(token_counts.MOVES)
    rng = np.random.default_rng(2)
    maps = rng.integers(0, len(elements), 500).astype(np.uint8)
    state, want = tuple(range(5)), []
    for m in maps:
        state = tuple(elements[m][s] for s in state)
        want.append(state)
    for chunk in (2, 9, 600):
        assert [elements[k] for k in token_counts.composed(maps, product, chunk)] == want


def test_quality_learns_and_holds_out(spark):
    d = "/root/testdata/sf0.01"
    got = quality.op4_factorisation_machine(spark, d).join(table(spark, d, "labels"), "doc_id").collect()
    out = [r for r in got if r.held_out]
    assert len(out) > 50 and np.mean([r.predicted == r.quality for r in out]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)


def test_quality_without_labels_and_with_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, 1, 0), (None, 0, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    for marks in (labels, labels.limit(0)):
        got = quality.quality_scores(odd, marks)
        assert got.count() == len(ROWS) and got.where("score is null or held_out is null").count() == 0
    assert quality.accepted(odd, labels).columns == odd.columns
    assert quality.quality_scores(odd.limit(0), labels).count() == 0


def test_factorisation_machine_equals_the_pair_sum():
    texts = [b"ab cd ab!", b"", b"EF gh ij kl"]
    buf, off = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    f = quality.features(buf, off, 4)
    fm = quality.fit(f, np.array([1.0, 0.0, 1.0]), 4, 3, 2)
    z = fm.standard(f.stats)
    for d in range(3):
        x = np.zeros(16)
        part = slice(f.bounds[d], f.bounds[d + 1])
        x[f.bucket[part]] = f.value[part]
        x, w, v = np.append(x, z[d]), np.append(fm.weight, fm.stat_weight), np.vstack([fm.factor, fm.stat_factor])
        s = fm.bias + x @ w + sum(v[i] @ v[j] * x[i] * x[j] for i in range(len(x)) for j in range(i))
        assert fm.score(f)[d] == pytest.approx(1 / (1 + np.exp(-s)))


def brute_components(texts, n):
    sets = {}
    for i, t in texts:
        w = words_of((t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
        sets[i] = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} - {()}
    root = {i: i for i in sets}
    for i in sorted(sets):
        for j in sorted(sets):
            if j < i and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((root[i], root[j]))
                root = {k: a if r == b else r for k, r in root.items()}
    return {i: (len(sets[i]), root[i]) for i in sets}


def test_near_dedup_equals_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 7)
    rng = np.random.default_rng(5)
    texts = [(i, t) for i, t in enumerate(["", None, "one", "ONE", "one two", " one\ttwo "])]
    for base in range(12):
        w = [f"w{base}_{k}" for k in range(int(rng.integers(6, 120)))]
        for _ in range(12):
            v = list(w)
            for k in rng.integers(0, len(v), int(rng.integers(0, 1 + len(v) // 25 + 1))):
                v[k] = f"e{rng.integers(1 << 30)}"
            texts.append((len(texts), " ".join(v)))
    got = near_dedup.near_dedup(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    want = brute_components(texts, 4)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_dedup_nulls(odd):
    got = near_dedup.near_dedup(odd).collect()
    assert {r.component_id for r in got if r.doc_id in (1, 2, 8)} == {1}
    assert sum(r.kept for r in got if r.doc_id is None) == 1  # the null text; the copy of 1 goes


def test_components_of_paths(spark):
    for path in ([1, 5, 4, 3, 2], [3, 7, 1, 9, 2, 8, 5, 6, 4], [10, 1, 9, 2, 8, 3, 7, 4, 6, 5, 12, 11]):
        edges = spark.createDataFrame([(bytes([a]), bytes([b])) for a, b in zip(path, path[1:])], "a binary, b binary")
        got = [(r.node[0], r.root[0]) for r in near_dedup.components(edges).collect()]
        assert sorted(got) == [(n, 1) for n in sorted(path) if n > 1]


def test_jump_hash_moves_rows_only_into_the_new_shard():
    keys = np.random.default_rng(1).integers(0, 1 << 63, 20000, dtype=np.uint64)
    now = sharding.jump_numpy(keys, 1)
    assert (now == 0).all()
    for n in range(2, 45):
        then = sharding.jump_numpy(keys, n)
        assert ((then == now) | (then == n - 1)).all()
        now = then
    assert np.bincount(now).min() > 300

    def one(key, n):
        b, j = -1, 0
        while j < n:
            b = j
            key = (key * 2862933555777941757 + 1) % (1 << 64)
            j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
        return b

    assert [one(int(k), 40) for k in keys[:200]] == list(sharding.jump_numpy(keys[:200], 40))


def test_slots_are_gapless(spark, odd):
    for df in (sharding.sharded(table(spark, SF, "documents"), parts=3), sharding.sharded(odd, 3, 2)):
        got = df.collect()
        by = Counter(r.shard for r in got)
        assert {(r.shard, r.slot) for r in got} == {(s, k) for s, n in by.items() for k in range(n)}


def test_warc_round_trip(spark):
    pages = [(1, "u\r\nx", "a WARC/1.1\r\nb\r\n\r\nWARC/1.1WARC/1.1"), (2, None, None), (3, "u", ""), (4, "v", "é\x00z"), (5, "w", "WARC/1.1"),
             (5, "w", "WARC/1.1"), (None, "q", "WWARC/1.1\r\n"), (8, "q", "WWARC/1.1\r\n"), (9, "WARC/1.1", "HTTP/1.1\r\n\r\n\r\n"), (10, "l", "y" * 300000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("digest", F.lit("x"))
    path = scratch_path(spark, "warc-test")
    got = warc.archived(df, path).collect()
    assert Counter(r.page_id for r in got) == Counter(p[0] for p in pages)
    said = sorted((r.page_id, r.record_type, r.refers_to) for r in got if r.page_id in (2, 3, 5, 8))
    assert said == [(2, "response", None), (3, "revisit", 2), (5, "response", None), (5, "revisit", 5), (8, "response", None)]
    kept = {bytes(r.payload) for r in warc.read_warc(spark, path).where("type = 'response'").collect()}
    assert kept == {(p[2] or "").encode() for p in pages}
    nested = warc.captures(warc.read_warc(spark, path)).collect()
    assert all(len(r.requests) == len(r.metadata) == 1 for r in nested) and len(nested) == len(pages)
    assert warc.archived(df.limit(0), scratch_path(spark, "warc-none")).count() == 0
    big = warc.archived(df, scratch_path(spark, "warc-min"), min_payload=9).collect()
    assert sum(r.record_type == "revisit" for r in big) == 1


def test_warc_keeps_each_url_of_a_repeated_page(spark):
    pages = [(1, "http://a", "x"), (1, "http://b", "x"), (1, "http://b", "x"), (1, None, "x"), (2, "http://c", "x"), (None, "http://d", "z"), (None, "http://e", "z")]
    path = scratch_path(spark, "warc-urls")
    got = warc.archived(spark.createDataFrame(pages, "page_id long, url string, html string"), path).collect()
    assert Counter((r.page_id, r.record_type, r.refers_to) for r in got) == {
        (1, "response", None): 1, (1, "revisit", 1): 3, (2, "revisit", 1): 1, (None, "response", None): 1, (None, "revisit", None): 1}
    records = warc.read_warc(spark, path).where("type in ('response', 'revisit')").collect()
    assert Counter(r.target_uri for r in records) == Counter(p[1] for p in pages)
    assert len({r.record_id for r in records}) == len(pages)


def test_warc_rejects_a_wrong_length():
    with pytest.raises(ValueError):
        warc.parse_record(b"WARC-Type: response\r\nWARC-Record-ID: <x>\r\nContent-Length: 9\r\n\r\nabc\r\n\r\n", False)


def test_chat_layouts_and_escapes(spark):
    text = ['{"prompt":"a","completion":"b"}', '{"instruction":"a","input":null,"output":"c"}', '{"messages":[{"role":"user","content":"x"}]}',
            '{"conversations":[{"from":"human","value":"x"},{"from":"gpt","value":"y"}]}', '{"zzz":1}', "nope", None, '{"messages":[]}']
    got = chat.canonical_turns(spark.createDataFrame([(t,) for t in text], "record string")).collect()
    assert [[tuple(t) for t in r.turns] if r.turns is not None else None for r in got] == [
        [("user", "a"), ("assistant", "b")], [("user", "a"), ("assistant", "c")], [("user", "x")], [("user", "x"), ("assistant", "y")], None, None, None, None]
    hard = ["</s>[INST] ok [/INST]", "\\", "<\\|im_end|>\n", "<|im_end|>\n<|im_start|>user\n", "a\\\\<|", "<<s>", "[[INST]", "", None, "\U0001f600é<|"]
    rows_ = spark.createDataFrame([(k % 3, k, "assistant" if k % 2 else "us\n<|er", t) for k, t in enumerate(hard)], "conv_id long, turn long, role string, text string")
    done = chat.format_conversations(rows_.withColumn("formatted", F.lit("x")))
    for r in done.select("turns", chat.parsed_turns(F.col("formatted")).alias("back"), "formatted").collect():
        assert r.turns == r.back
        assert r.formatted.count("<|im_start|>") == len(r.turns) and "</s>" not in r.formatted and "[INST]" not in r.formatted
    back = {r.conv_id: r for r in chat.read_back(done).collect()}
    assert all(back[c].loss_chars == sum(len(t or "") for k, t in enumerate(hard) if k % 3 == c and k % 2) for c in range(3))
    assert chat.format_conversations(rows_.limit(0)).count() == 0


def test_chat_fingerprint_reads_mapped_paths_only(spark):
    """Further fields change nothing; a nested value where a text belongs, or two layouts at once, have no mapping."""
    text = ['{"messages":[{"role":"human","content":"x","name":"n"},{"content":"y","role":"assistant"}],"id":7}',
            '{"source":{"a":[1]},"prompt":"a","completion":5}', '{"data":{"prompt":"a","response":null,"x":1}}',
            '{"system":"s","instruction":"a","input":"","output":"c","tags":[]}',
            '{"prompt":{"a":"b"},"completion":"c"}', '{"prompt":"a","completion":"b","response":"c"}',
            '{"messages":[{"role":"user","content":[{"text":"x"}]}]}', '{"messages":"x"}', "[1]", "{", None]
    rows_ = spark.createDataFrame([(t, 1, 2) for t in text], "record string, parsed int, _v int")
    got = chat.canonical_turns(rows_)
    assert got.columns == ["record", "parsed", "_v", "fingerprint", "turns"]
    assert [r.turns and [tuple(t) for t in r.turns] for r in got.collect()] == [
        [("human", "x"), ("assistant", "y")], [("user", "a"), ("assistant", "5")], [("user", "a")],
        [("system", "s"), ("user", "a"), ("assistant", "c")], None, None, None, None, None, None, None]
    found = chat.layouts_found(got).collect()
    assert sum(r.records for r in found) == len(text) and sum(r.records for r in found if r.layout is None) == 7
    assert {r.layout for r in found} == {"messages", "prompt and completion", "nested prompt", "instruction with system", None}
    assert [r.records for r in found if r.fingerprint is None] == [2]
    assert "parts" in chat.formatted(got.withColumn("parts", F.lit(3))).columns


def test_chat_conversations_use_every_layout(spark):
    """Conversations dealt over all layouts come back turn by turn, with roles and empty texts as they were."""
    data = []
    for c in range(200):
        data += [(c, 0, "user", f"q{c}"), (c, 1, "assistant", f"a\n{c}")]
        data += [(1000 + c, 0, "system", "s"), (1000 + c, 1, "user", "q"), (1000 + c, 2, "assistant", f"a{c}")]
        data += [(2000 + c, 0, "human", "q"), (2000 + c, 1, "gpt", None), (3000 + c, 0, "user", ""), (3000 + c, 1, "assistant", "x")]
    rows_ = spark.createDataFrame(data, "conv_id long, turn int, role string, text string")
    done = chat.format_conversations(rows_)
    want = {}
    for c, _, role, text in data:
        want.setdefault(c, []).append((role, text or ""))
    assert {r.conv_id: [tuple(t) for t in r.turns] for r in done.collect()} == want
    found = {r.layout: r.records for r in chat.layouts_found(done).collect()}
    assert set(found) == {layout.name for layout in chat.LAYOUTS} and min(found.values()) > 10


def test_smith_waterman_equals_the_table():
    rng = np.random.default_rng(2)
    for _ in range(200):
        a, b = (rng.integers(0, 4, rng.integers(1, 15)).astype(np.uint64) for _ in range(2))
        h = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                h[i + 1, j + 1] = max(0, h[i, j] + (1 if a[i] == b[j] else -1), h[i, j + 1] - 1, h[i + 1, j] - 1)
        assert decontaminate.smith_waterman(a, b) == h.max()


def test_leaks_finds_edited_copies_only(spark):
    item = [f"q{k}" for k in range(30)]
    edited = [w if k % 7 else "other" for k, w in enumerate(item)]
    noise = [f"n{k}" for k in range(400)]
    docs = spark.createDataFrame([(1, " ".join(noise + item + noise)), (2, " ".join(noise + edited).upper()), (3, " ".join(noise)), (4, " ".join(noise + item[:6])),
                                  (None, " ".join(item)), (6, None), (7, ""), (1, " ".join(noise + item + noise))], "doc_id long, text string").withColumn("seeds", F.lit(1))
    bench = spark.createDataFrame([(0, " ".join(item)), (1, "too short"), (2, None), (None, " ".join(f"z{k}" for k in range(9)))], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.score for r in decontaminate.leaks(docs, bench).collect()}
    assert set(got) == {(1, 0), (2, 0), (None, 0)} and got[(1, 0)] == 1.0
    assert decontaminate.leaks(docs.limit(0), bench).count() == 0 and decontaminate.leaks(docs, bench.limit(0)).count() == 0


def test_leaks_equals_all_pairs(spark):
    rng = np.random.default_rng(11)
    items, docs = [], []
    for k, n in enumerate((12, 12, 16, 16, 28, 38, 59, 75, 150, 9)):
        item = [f"i{k}_{j}" if rng.random() < 0.7 else f"c{rng.integers(6)}" for j in range(n)]
        items.append((k, " ".join(item)))
        copies = [[x for j, w in enumerate(item) for x in ([w, "new"] if j % 3 == 2 else [w])],
                  [w if j % 4 != 3 else "new" for j, w in enumerate(item)], [w for j, w in enumerate(item) if j % 4 != 3]]
        for share in (0.15, 0.25, 0.35) * 4:
            copy = []
            for w in item:
                edit = rng.integers(3) if rng.random() < share else 3
                copy += [[], [f"e{rng.integers(99)}"], [w, f"e{rng.integers(99)}"], [w]][edit]
            copies.append(copy)
        for copy in copies:
            noise = [[f"c{x}" if x < 6 else f"n{x}" for x in rng.integers(0, 40, rng.integers(0, 400))] for _ in range(2)]
            docs.append((len(docs), " ".join(noise[0] + copy + noise[1])))
    got = {(r.doc_id, r.item_id): r.score for r in decontaminate.leaks(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    code, want = {}, {}
    for d, text in docs:
        for i, item in items:
            a, b = (np.array([code.setdefault(w, len(code)) for w in t.split()], np.uint64) for t in (item, text))
            score = decontaminate.smith_waterman(a, b)
            if score >= decontaminate.needed(len(a)):
                want[d, i] = score / min(len(a), 60)
    assert {(15 * k + j, k) for k in range(2, 9) for j in (0, 1)} <= set(want)
    assert got == want


def test_short_items_are_found_whole_only(spark):
    items = ["yes", "two words", "the end of", "a b c d e", "how far is it to the moon", "k1 k2 k3 k4 k5 k6 k7 k8 k9 k10 k11 k12", " ", None]
    texts = ["x yes y", "two", "one two\tWORDS three", "two x words", "the end x of the end", "so the end of it", "z a b c d y e", "a b c d e",
             "how far is it to the sun", "ask how far is it to the moon now", "k1 k2 k3 k4 k5 k6 x", "y k1 k2 k3 k4 k5 k6 k7 k8 x", "yes", ""]
    got = decontaminate.leaks(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"),
                              spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(0, 0), (12, 0), (2, 1), (5, 2), (7, 3), (9, 4), (11, 5)}
    assert all(r.score == (1.0 if r.item_id != 5 else 8 / 12) for r in got)


def test_frequent_seeds_are_not_joined(spark):
    item = [f"w{k}" for k in range(16)]
    docs = spark.createDataFrame([(k, " ".join(item if k == 0 else item[:4])) for k in range(9)], "doc_id long, text string")
    items = decontaminate.items_of(spark.createDataFrame([(0, " ".join(item))], "item_id long, text string"))
    counts = decontaminate.seed_counts(docs, np.full(128, 255, np.uint8), 1024, False)
    code = decontaminate.gram_hashes(next(decontaminate._words(decontaminate.pa.array([" ".join(item)]))), 2).view(np.int64)
    got = {r.seed for r in decontaminate.rare_seeds(items, counts).collect()}
    assert len(got) == 15 - 7 + 1 and got < set(code[3:].tolist())
    row, = decontaminate.leaks(docs, spark.createDataFrame([(0, " ".join(item))], "item_id long, text string")).collect()
    assert (row.doc_id, row.score, row.seed_passages) == (0, 1.0, 1)


def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    total, fixed = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        if not free:
            return fixed
        share = (total - sum(fixed.values())) / sum(weight[s] for s in free)
        over = [s for s in free if share * weight[s] > 2 * sizes[s]]
        if not over:
            return fixed | {s: share * weight[s] for s in free}
        fixed |= {s: 2.0 * sizes[s] for s in over}


def test_mix_targets_and_totals(spark):
    rng = np.random.default_rng(3)
    data = [(k, "w " * int(rng.integers(0, 40)), [None, "b", "a", "é", "Z"][int(rng.choice(5, p=[.05, .1, .5, .2, .15]))]) for k in range(900)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    got = mixing.mixture(docs).collect()
    sizes = Counter()
    for _, t, s in data:
        sizes[s] += len(words_of(t))
    want, where = brute_targets(sizes), {d[0]: d[2] for d in data}
    taken = Counter()
    for r in got:
        assert r.target == pytest.approx(want[where[r.doc_id]]) and r.source_size == sizes[where[r.doc_id]]
        assert r.taken in (0, r.size, 2 * r.size)
        taken[where[r.doc_id]] += r.taken
    assert all(abs(taken[s] - want[s]) <= 40 for s in sizes)
    spark.conf.set("spark.sql.shuffle.partitions", 3)
    try:
        again = mixing.mixture(docs.repartition(5)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert {r.doc_id: r.taken for r in again} == {r.doc_id: r.taken for r in got}


def test_mix_keeps_other_columns(odd):
    assert mixing.repeated(odd).columns == odd.columns


def test_mix_of_null_and_repeated_ids_in_other_layouts(spark):
    """Rows without an id, of one size, and rows that are alike in all: the same texts are taken in any layout."""
    data = [(None, f"t{k} w w", "a") for k in range(300)] + [(7, "same words", "a")] * 200 + [(k % 9, f"u{k}", "b") for k in range(300)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string").withColumn("_of", F.lit(5)).withColumn("of", F.lit(6))
    want = rows(mixing.repeated(docs).select("doc_id", "text"))
    for n in (1, 7):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        try:
            assert rows(mixing.repeated(docs.repartition(n, "text")).select("doc_id", "text")) == want
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 8)
    same = Counter(r for r in want)[(7, "same words")]
    assert 250 < same <= 400 and set(mixing.repeated(docs).select("_of", "of").distinct().collect()) == {(5, 6)}


def test_ranks_go_on_between_batches():
    cell, key = np.array([1, 1, 1, 1, 2, 2, 2, 3, 3, 3, 3, 3]), np.array([5, 5, 5, 6, 6, 6, 6, 6, 6, 6, 6, 7])
    want = [0, 1, 2, 0, 0, 1, 2, 0, 1, 2, 3, 0]
    for cut in range(len(key) + 1):
        for end in range(cut, len(key) + 1):
            got, run = [], None
            for lo, hi in ((0, cut), (cut, end), (end, len(key))):
                rank, run = mixing._ranks(cell[lo:hi], key[lo:hi], run)
                got += rank.tolist()
            assert got == want


def test_pivotal_rounding_is_fair():
    """Each document's share of being taken is its probability, and a pair's words stay: over many draws, sizes far apart."""
    rng = np.random.default_rng(11)
    size, p = np.array([1, 9, 4, 4, 30, 2, 7, 0, 12.0]), np.array([.5, .1, .9, .25, .4, 1, .6, .5, .3])
    cell = np.zeros(len(p), np.int64)
    total, n = np.zeros(len(p)), 6000
    for _ in range(n):
        out, _, held, _ = mixing._play(size, p, rng.random(len(p)), cell, None)
        assert np.isnan(out).sum() == (held is not None)
        assert held is None or np.isnan(out[held[3]])
        if held:
            out[held[3]] = held[2]
        assert np.dot(out, size) == pytest.approx(np.dot(p, size))
        assert all(v in (0, 1) for k, v in enumerate(out) if held is None or k != held[3])
        total += out
    assert np.abs(total / n - np.where(size > 0, p, 0)).max() < .03


def test_a_level_in_batches_equals_one_stream():
    """The carry between batches: cut anywhere, the rows get what one stream gives them."""
    rng = np.random.default_rng(5)
    n = 40
    size, p, draw, cell = rng.integers(0, 9, n).astype(float), rng.random(n), rng.random(n), np.sort(rng.integers(0, 4, n))
    want, _, _, ended = mixing._play(size, p, draw, cell, None)
    for cut in range(n + 1):
        one, _, held, _ = mixing._play(size[:cut], p[:cut], draw[:cut], cell[:cut], None)
        two, closed, _, _ = mixing._play(size[cut:], p[cut:], draw[cut:], cell[cut:], held and held[:3])
        got = np.concatenate([one, two])
        if held and closed is not None:
            got[held[3]] = closed
        np.testing.assert_allclose(got, want)
