"""Row-local operators: quality rules, chat formatting, byte-level BPE, language identification."""

import hashlib
import math
import re
import zlib

import pytest
from pyspark.sql import functions as F

from sparkplate.llm import bpe, chat, langid, quality
from llm_fixtures import ODD, SMALL, frame, none, odd, small  # noqa: F401


# --- quality rules ---------------------------------------------------------------------

def measured(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    hit = {i + k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(3)} if len(w) < 3000 else None
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            None if hit is None else len(hit))


def test_quality_measures_match_brute_force(spark, odd):
    led = quality.ledger(odd)
    got = [tuple(r) for r in led.select("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()]
    want = [measured(r[1]) for r in ODD]
    assert [g[:4] for g in got] == [w[:4] for w in want]
    for g, w in zip(got, want):
        assert w[4] is None and g[4] == 20000 or g[4] == w[4]
    assert "source" in led.columns and led.columns.count("n_words") == 1


def test_quality_policies_and_ablation(spark, small):
    led = quality.ledger(small[0]).cache()
    for policy, rules in quality.POLICIES.items():
        m = quality.mask(policy)
        bits = [r["fail_bits"] for r in led.collect()]
        kept = quality.judge(led, policy).where("kept").count()
        assert kept == sum(b & m == 0 for b in bits)
        for r in quality.ablation(led, policy).collect():
            bit = quality.BIT[r["rule"]]
            assert r["failed"] == sum(bool(b & bit) for b in bits)
            assert r["failed_alone"] == sum(b & m == bit for b in bits)
            assert r["kept_without"] == sum(b & m & ~bit == 0 for b in bits)
    assert {r["doc_id"] for r in quality.keep_good(small[0]).collect()} == {
        r["doc_id"] for r in quality.judge(led, quality.POLICY).where("kept").collect()}


def test_quality_query_carries_policies_and_ablation(spark, tmp_path):
    """Every policy and the ablation stand beside the measures; odd rows keep their number."""
    texts = [None, "", "one two", "word " * 60, "# " * 200, " ".join(f"w{i}" for i in range(60)), "A B " * 40, "one two"]
    spark.createDataFrame([(None if i == 5 else 1, t, "x") for i, t in enumerate(texts)],
                          "doc_id bigint, text string, sole_rule string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = quality.op1_quality_rules(spark, str(tmp_path)).collect()
    bits = [r["fail_bits"] for r in rows]
    assert len(rows) == len(texts)
    for r in rows:
        for policy in quality.POLICIES:
            assert r["kept_" + policy.replace("-", "_")] == (r["fail_bits"] & quality.mask(policy) == 0)
        assert r["kept"] == r["kept_web_2"] and r["base_failed"] != r["kept_base_1"]
        alone = [name for name, bit in quality.BIT.items() if bit == r["fail_bits"]]
        assert r["sole_rule"] == (alone[0] if alone else None)
        if alone:
            bit = quality.BIT[alone[0]]
            assert r["rule_failed"] == sum(bool(b & bit) for b in bits) and r["rule_failed_alone"] == bits.count(bit)
            assert r["kept_without_rule"] == sum(b & ~bit == 0 for b in bits)
    assert any(r["sole_rule"] for r in rows)


def test_quality_empty_table(none):
    assert quality.ledger(none).count() == 0
    assert quality.keep_good(none).columns == none.columns


# --- chat formatting -------------------------------------------------------------------

TALK = [
    (1, 1, "assistant", "yes </s> [INST]"), (1, 0, "user", "\\ <s> <\\s> \\[INST]"), (1, 2, None, None),
    (2, 0, "[/INST]", "<</s>"), (2, 0, "assistant", ""), (2, 0, "assistant", "\\"), (2, None, "system", "first\nline"),
    (None, 0, "assistant", "no id é漢"), (3, 5, "assistant", "[/INST][INST"), (3, 6, "assistant", "</s"),
    (3, 6, "assistant", "</s"), (4, 0, "user", "x" * 50000),
]


def test_chat_reads_back(spark):
    rows = spark.createDataFrame([(*r, "clash") for r in TALK], "conv_id bigint, turn int, role string, text string, turns string")
    done = chat.template(chat.canonical(chat.records_of(rows)).drop("record"))
    got = {r["conv_id"]: r for r in done.select(
        "conv_id", "layout", "formatted", chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}
    assert set(got) == {r[0] for r in TALK}
    for conv, r in got.items():
        turns = sorted(((-1 if t is None else t, role or "", text or "") for c, t, role, text in TALK if c == conv))
        assert [tuple(t) for t in r["turns"]] == [t[1:] for t in turns]
        assert r["loss"] == "".join(t[2] for t in turns if t[1] == "assistant")
        assert r["layout"] == "messages"
        bodies = re.sub(r"<s>\[INST\](.*?)\[/INST\](.*?)</s>", "", r["formatted"], flags=re.S)
        assert bodies == ""


def test_chat_layouts(spark):
    records = [
        ('{"messages":[{"role":"user","content":"a"},{"role":"assistant","content":null}]}', "messages", [("user", "a"), ("assistant", "")]),
        ('{"messages":[]}', "messages", []),
        ('{"conversations":[{"from":"human","value":"a"},{"from":"gpt","value":"b"}]}', "from_value", [("user", "a"), ("assistant", "b")]),
        ('{"prompt":"a","completion":"b"}', "prompt_completion", [("user", "a"), ("assistant", "b")]),
        ('{"response":"b","prompt":"a","system":"s"}', "prompt_response", [("system", "s"), ("user", "a"), ("assistant", "b")]),
        ('{"instruction":"a","input":"i","output":"o"}', "instruction", [("user", "a\n\ni"), ("assistant", "o")]),
        ('{"instruction":"a","input":"","output":5}', "instruction", [("user", "a"), ("assistant", "5")]),
        ('{"instruction":"a","output":"o"}', "instruction", [("user", "a"), ("assistant", "o")]),
        ('{"what":1}', None, []), ("not json", None, []), (None, None, []),
    ]
    df = spark.createDataFrame([(i, r[0], "x") for i, r in enumerate(records)], "id int, record string, layout string")
    got = sorted(chat.canonical(df).collect(), key=lambda r: r["id"])
    assert [(r["layout"], [tuple(t) for t in r["turns"]]) for r in got] == [r[1:] for r in records]


def test_chat_gathered_turns_equal_records(spark):
    rows = spark.createDataFrame([(*r, "clash") for r in TALK], "conv_id bigint, turn int, role string, text string, turns string")
    one, two = chat.conversations(rows).collect(), chat.canonical(chat.records_of(rows)).drop("record").collect()
    assert sorted(map(repr, one)) == sorted(map(repr, two))


def test_chat_records_of_all_layouts(spark):
    """Turns survive the layout drawn for them, whatever roles, blank lines and nulls they hold."""
    names = tuple(x.name for x in chat.LAYOUTS)
    texts = ["a", "", "a\n\nb", "a\n\n", "\n\nb", "\n\n\n", None, "x\n\ny\n\nz", "é漢\n\n\"q\""]
    heads = [("user", "assistant"), ("system", "user", "assistant"), ("human", "gpt"), ("user",), ("assistant", "user"), (None, "tool")]
    rows = [(len(texts) * 100 * k + 100 * t + c, i, role, texts[(t + i) % len(texts)], "clash")
            for k, roles in enumerate(heads) for t in range(len(texts)) for c in range(6) for i, role in enumerate(roles)]
    rows += [(None, i, r, "no id", "clash") for i, r in enumerate(("user", "assistant"))]
    df = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string, shape string")
    got = chat.conversations(df, names).collect()
    want = {}
    for conv, i, role, text, _ in rows:
        want.setdefault(conv, []).append((role or "", text or ""))
    assert len(got) == len(want) and {r["layout"] for r in got} == set(names)
    for r in got:
        assert [tuple(t) for t in r["turns"]] == want[r["conv_id"]], r
    assert {r["layout"] for r in got if {"human", "gpt"} & {t["role"] for t in r["turns"]}} == {"messages"}


@pytest.mark.parametrize("gather", [chat.conversations, lambda rows: chat.canonical(chat.records_of(rows)).drop("record")])
def test_chat_long_turns_stay(spark, gather):
    """A text beyond the 20,000,000 characters at which JSON parsers stop."""
    rows = spark.range(2).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("assistant").alias("role"),
                                 F.expr("CASE id WHEN 0 THEN repeat('a\\\\ \"b\" ', 3200000) ELSE 'short' END").alias("text"))
    done = chat.template(gather(rows))
    r, = done.select("layout", F.size("loss_spans").alias("n"), F.length(chat.read_loss(F.col("formatted"), F.col("loss_spans"))).alias("c")).collect()
    size = rows.select(F.sum(F.length("text")).alias("c")).collect()[0]["c"]
    assert size > 20_000_000 and (r["layout"], r["n"], r["c"]) == ("messages", 2, size)


def test_chat_no_json_stays_unknown(spark):
    bad = [r'{"prompt":"\q","completion":"b"}', '{"prompt":"a\nb","completion":"b"}', '{"prompt":"a,"completion":"b"}', '{"prompt":"a","completion":"b']
    odd = [(r'{"prompt": "x\": \"y", "completion" : "\\"}', 'x": "y')]
    got = chat.canonical(spark.createDataFrame([(x,) for x in bad + [o[0] for o in odd]], "record string")).collect()
    assert [r["layout"] for r in got] == [None] * len(bad) + ["prompt_completion"]
    assert got[-1]["turns"][0]["text"] == odd[0][1] and got[-1]["turns"][1]["text"] == "\\"


def test_chat_empty_table(spark):
    rows = spark.createDataFrame([], "conv_id bigint, turn int, role string, text string")
    assert chat.conversations(rows).count() == 0
    assert chat.template(chat.canonical(chat.records_of(rows))).count() == 0


# --- byte-level BPE --------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    import public_tokenizers as P
    import tiktoken

    ranks = bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _encoder(spark):
    import public_tokenizers as P

    return bpe.Encoder(spark, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)


@pytest.mark.parametrize("head", [0, 50])
def test_bpe_matches_library(spark, odd, library, head):
    encoder = _encoder(spark)
    if head:
        encoder.learn(odd, head)
    rows = bpe.decode(bpe.encode(odd, encoder), encoder).select("text", "ids", F.col("bytes").alias("back")).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        assert r["ids"] == library.encode_ordinary(r["text"] or ""), (r["text"] or "")[:60]
        assert bytes(r["back"]) == (r["text"] or "").encode()


def test_bpe_folds_runs_and_random_words(spark, library):
    import random

    rng = random.Random(7)
    texts = ["a" * n for n in (1, 2, 3, 7, 64, 333)] + ["=" * 200, "aab" * 50, " " * 90 + "x", "\n\n\n  \t" * 9]
    texts += ["".join(rng.choice("aeinrst") for _ in range(rng.randint(1, 60))) for _ in range(300)]
    texts += ["".join(chr(rng.randint(33, 700)) for _ in range(30)) for _ in range(100)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    got = {r["text"]: r["ids"] for r in bpe.encode(df, _encoder(spark)).collect()}
    assert all(got[t] == library.encode_ordinary(t) for t in texts)


def test_bpe_folds_a_word_once_a_task(library, monkeypatch):
    """F op7: a word outside the head was folded at each of its places."""
    import public_tokenizers as P
    import pyarrow as pa

    ranks = bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    folded, fold = [], bpe.fold_bytes
    monkeypatch.setattr(bpe, "fold_bytes", lambda word, r: folded.append(word) or fold(word, r))
    lists = [[" zqxv", " wjk", " zqxv"], [], [" zqxv", "ñ漢"], [" wjk", "y" * 100, "y" * 100]]
    want = [",".join(str(i) for w in ws for i in library.encode_ordinary(w)) for ws in lists]

    def told(known, words):
        return [x for part in known.told(words) for x in part.to_pylist()]

    known, column = bpe.Known(ranks, b""), pa.array([["a"], *lists], pa.list_(pa.string())).slice(1)
    assert told(known, column) == want
    assert len(folded) == 3 + 1  # four distinct words
    assert told(known, pa.array(lists, pa.list_(pa.string()))) == want
    assert sorted(set(folded)) == sorted({w.encode() for ws in lists for w in ws})
    assert len(folded) == 3 + 2  # words longer than KEPT are not kept
    monkeypatch.setattr(bpe, "WORDS", 2)
    assert told(bpe.Known(ranks, b"", most=1), column) == want  # forgets words, not ids
    assert told(known, column.slice(0, 0)) == []


def test_bpe_folds_bytes_as_library(library):
    import random

    import public_tokenizers as P

    ranks, rng = bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken")), random.Random(11)
    words = ["a" * n for n in (1, 2, 3, 64, 333)] + ["=" * 200, "漢" * 40, "\x85", "́"]
    words += ["".join(rng.choice("aeinrst") for _ in range(rng.randint(1, 40))) for _ in range(500)]
    for w in words:
        assert bpe.fold_bytes(w.encode(), ranks) == library._core_bpe.encode_single_piece(w.encode()), w


def test_bpe_empty_table(spark, none):
    encoder = _encoder(spark)
    encoder.learn(none)
    assert bpe.encode(none, encoder).count() == 0


# --- language identification -----------------------------------------------------------

def test_language_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = langid.op8_language_id(spark, sf).collect()
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    assert len(got) == len(truth)
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_model_depends_on_rows_alone(spark, small):
    df = small[0].select("doc_id", "text", "lang")
    labelled = df.where("lang IS NOT NULL")
    copies = labelled.unionByName(labelled.where("lang = 'en'").limit(1).crossJoin(spark.range(500)).drop("id"))
    told = []
    for train in (labelled.coalesce(1), labelled.repartition(7, "text").withColumn("doc_id", F.col("doc_id") * -3)):
        told.append({r["doc_id"]: (r["lang_pred"], r["score"], r["rejected"]) for r in langid.predict(df, langid.fit(train)).collect()})
    assert told[0] == told[1]
    drawn = [sorted(map(tuple, langid.sample(t, 20).collect())) for t in (labelled, copies)]
    assert all(len(set(d)) == len(d) for d in drawn)  # copies of a text are drawn once


def test_language_matches_plain_computation(spark, small):
    """TF-IDF, k-means and cosines once more, over dictionaries; every text is in the sample."""
    rows = [(text, lang) for _, text, lang, _ in small[1]]

    def counts(text):
        letters = "".join(c if c.isalpha() or ord(c) > 127 else " " for c in text.lower())
        raw = b" " + b" ".join(letters.encode().split()) + b" "
        out = {}
        for i in range(len(raw) - 2):
            h = int.from_bytes(raw[i:i + 3], "big") * 0x9E3779B1 % 2**32 >> 18
            out[h] = out.get(h, 0) + 1
        return out

    train = [(t, lang) for t, lang in rows if t and lang and any(map(str.isalpha, t))]
    df = {}
    for t, _ in train:
        for h in counts(t):
            df[h] = df.get(h, 0) + 1
    idf = lambda h: math.log((1 + len(train)) / (1 + df.get(h, 0))) + 1

    def unit(v):
        size = math.sqrt(sum(x * x for x in v.values()))
        return {h: x / size for h, x in v.items()}

    def vector(t):
        return unit({h: math.log1p(n) * idf(h) for h, n in counts(t).items()})

    def dot(a, b):
        return sum(x * b.get(h, 0.0) for h, x in a.items())

    def total(vs):
        out = {}
        for v in vs:
            for h, x in v.items():
                out[h] = out.get(h, 0.0) + x
        return out

    centroids = []
    for lang in sorted({lang for _, lang in train}):
        xs = [vector(t) for t in sorted({t for t, known in train if known == lang})]
        assert len(xs) <= langid.SAMPLE
        mean, k = total(xs), min(langid.CENTROIDS, len(xs))
        order = sorted(range(len(xs)), key=lambda i: dot(xs[i], mean))
        cs = [xs[order[int(i * (len(xs) - 1) / (k - 1)) if k > 1 else 0]] for i in range(k)]
        for _ in range(langid.ROUNDS):
            own = [max(range(k), key=lambda c: dot(x, cs[c])) for x in xs]
            cs = [unit(total(x for x, o in zip(xs, own) if o == c) or cs[c]) for c in range(k)]
        centroids += [(lang, c) for c in cs]
    model = langid.fit(small[0].where("lang IS NOT NULL").select("doc_id", "text", "lang"))
    wrong = 0
    for t, _ in rows:
        lang, score, _ = model.judge(t)
        if t and any(map(str.isalpha, t)):
            v = vector(t)
            best = max(centroids, key=lambda c: dot(v, c[1]))
            wrong += abs(dot(v, best[1]) - score) > 1e-3 or best[0] != lang
        else:
            assert (lang, score) == ("und", 0.0)
    assert wrong == 0


def test_language_odd_rows(spark, odd, none):
    train = odd.where(~langid.held_out(F.col("doc_id")) & F.col("lang").isNotNull())
    model = langid.fit(train.select("doc_id", "text", "lang"))
    rows = langid.predict(odd, model, ("doc_id", "n")).collect()
    assert len(rows) == len(ODD)
    texts = [r[1] for r in ODD]
    assert [r["lang_pred"] == "und" for r in rows] == [not any(c.isalpha() for c in t or "") for t in texts]
    empty = langid.fit(none.select("doc_id", "text", "lang"))
    assert {r["lang_pred"] for r in langid.predict(odd, empty).collect()} == {"und"}
    assert langid.predict(none, model).count() == 0


def test_digests_of_the_query(spark, library):
    import public_tokenizers  # noqa: F401

    from sparkplate.llm.queries import QUERIES

    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = QUERIES["op7_byte_bpe"](spark, SMALL).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = library.encode_ordinary(docs[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(docs[r["doc_id"]].encode()).hexdigest()


def test_frame_has_clashing_names(spark):
    assert {"n", "node", "dig", "key"} <= set(frame(spark).columns)
