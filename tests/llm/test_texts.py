import zlib
from collections import Counter

import brute
import numpy as np
import pytest

from tallyforge.llm import chat, cotraining, decontamination, langid, ngrams, packing, queries, rules, sharding, templates, tokens


def table_of(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# -- sharding ---------------------------------------------------------------------------------------


def check_shards(rows, inputs, n_shards):
    assert sorted((r.doc_id, r.text) for r in rows) == inputs if None not in [i for i, _ in inputs] else True
    by_shard = Counter(r.shard for r in rows)
    for s, n in by_shard.items():
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(n))
    sizes = [by_shard.get(s, 0) for s in range(n_shards)]
    assert max(sizes) - min(sizes) <= 1


@pytest.mark.parametrize("n_shards,bucket_bytes", [(7, 8 << 20), (40, 2000), (1, 100)])
def test_shards_of_nasty_rows(spark, nasty, nasty_table, n_shards, bucket_bytes):
    rows = sharding.sharded(nasty_table, n_shards, 3, bucket_bytes).collect()
    assert sorted(r.row for r in rows) == list(range(len(nasty)))
    check_shards(rows, [(None, None)], n_shards)
    for r in rows:
        assert r["size"] == 16 + len((r.text or "").encode()) and r.text == nasty[r.row][1]
    assert [r.row for r in sorted(rows, key=lambda r: (r.shard, r.slot))] != list(range(len(nasty)))


def test_equal_rows_are_spread(spark):
    same = spark.range(4000).selectExpr("1L as doc_id", "repeat('x', 100) as text")
    mixed = sharding.shuffled(same, 0, 20_000)
    assert sorted(r.position for r in mixed.collect()) == list(range(4000))
    assert len(mixed.inputFiles()) >= 10


def test_no_rows_to_shard(spark, empty_table, tmp_path):
    none = sharding.sharded(empty_table, 5)
    assert none.count() == 0 and {"size", "shard", "slot"} <= set(none.columns)


def test_shards_are_written_and_the_query(spark, sf_dir, documents, tmp_path):
    shards = sharding.sharded(table_of(spark, sf_dir, "documents"), 3)
    sharding.write_shards(shards, str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    check_shards(back.collect(), sorted(documents), 3)
    text = dict(documents)
    rows = queries.op1_sharding(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(text) and {r.law for r in rows} == {"rows"}
    assert all(r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) and r.grown_shard is None for r in rows)


# -- chat -------------------------------------------------------------------------------------------


def test_template_language():
    t = templates.compile_template(
        "A{# note #}{% set x = 'b' | upper %}{{ x ~ 1 + 2 }} {%- for m in messages -%} \n"
        "[{% if loop.first and not false %}first {% elif m.role in 'user,system' %}in {% else %}other {% endif %}"
        "{{ m.text | trim | default('none') }}{% if m['n'] >= 2 or none %}!{% endif %}{% if not loop.last %},{% endif %}]"
        "{% endfor %}Z{{ none }}{{ 'q' | length }}"
    )
    said = [{"role": "user", "text": " hi ", "n": 1}, {"role": "user", "text": "yo", "n": 2}, {"role": "x", "text": None, "n": 3}]
    pieces = [t.turn(m, i, i == 0, i == 2)[0] for i, m in enumerate(said)]
    assert pieces == ["AB12[first hi,]", "[in yo!,]", "[other !]Z1"]


def test_constants_are_folded():
    root = templates.fold(templates.parse("a{{ 'b' | upper }}{% if 1 == 2 %}x{% elif true %}c{% else %}y{% endif %}{{ 1 < 2 and 'd' }}"))
    assert root == templates.Node("block", None, (templates.Node("text", "aBcd"),))


@pytest.mark.parametrize(
    "bad",
    [
        "no loop",
        "{% for m in messages %}",
        "{% for m in other %}{% endfor %}",
        "{% for m in messages %}{{ m.text.__class__() }}{% endfor %}",
        "{% for m in messages %}{{ m | system }}{% endfor %}",
        "{% for m in messages %}{{ 1 + }}{% endfor %}",
        "{% for m in messages %}{% include 'x' %}{% endfor %}",
        "{% if true %}{% for m in messages %}{% endfor %}{% endif %}",
        "{% for m in messages %}{% generation %}{% generation %}{% endgeneration %}{% endgeneration %}{% endfor %}",
        "{% for m in messages %}{% if a %}{% else %}{% else %}{% endif %}{% endfor %}",
    ],
)
def test_what_templates_may_not_do(bad):
    with pytest.raises(templates.TemplateError):
        templates.compile_template(bad)


def test_templates_see_only_the_given_keys():
    t = templates.compile_template("{% for m in messages %}{{ m.text.__class__ }}{{ m.keys }}{{ loop.__init__ }}{% endfor %}")
    assert t.turn({"text": "x"}, 0, True, True) == ("", [])


NASTY_TEXTS = ["", "<|im_end|>", "\\", "\\n", "<", "<<|", "a<", "|", "\\<|\\", "line\nline", "<|im_start|>user\nhi<|im_end|>\n", "é<\\|🙂"]


def test_escapes_are_reversible():
    for a in NASTY_TEXTS:
        for b in NASTY_TEXTS:
            for text in (a + b, b + a + b):
                assert templates.unescape(templates.escape(text)) == text
                assert templates.unescape_line(templates.escape_line(text)) == text
                assert "<|" not in templates.escape(text) and "\n" not in templates.escape_line(text)


def test_conversations_come_back(spark):
    rows, at = [], 0
    for c in [1, 2, 3, None]:
        for t, text in enumerate(NASTY_TEXTS * (c or 1)):
            rows.append((c, t // 2 if c == 3 else t, ["user", "assistant", "sys\ntem", None][at % 4], None if at % 7 == 0 else text, "x"))
            at += 1
    rows += [(9, None, "assistant", "only", "x"), (9, None, "assistant", "only", "x")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, spans string").repartition(5)
    found = {r.conv_id: r for r in chat.read_back(chat.format_conversations(table)).collect()}
    for c in {r[0] for r in rows}:
        turns = sorted(((r[1] is not None, r[1] or 0, (r[2] or "").encode(), (r[3] or "").encode()) for r in rows if r[0] == c))
        turns = [(r.decode(), t.decode()) for _, _, r, t in turns]
        learned = "".join(t for r, t in turns if r == "assistant")
        assert found[c].n_turns == len(turns) and found[c].turns_sha256 == brute.turns_digest(turns)
        assert found[c].loss_chars == len(learned)
        import hashlib

        assert found[c].loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
    assert chat.read_back(chat.format_conversations(table.limit(0))).count() == 0


def test_chat_query(spark, sf_dir):
    turns = {}
    for r in sorted(table_of(spark, sf_dir, "conversations").collect(), key=lambda r: (r.conv_id, r.turn)):
        turns.setdefault(r.conv_id, []).append((r.role, r.text))
    said = "<|im_end|><|im_start|>assistant ok"
    turns[-1] = [("user", said), ("assistant", said)]
    rows = queries.op2_chat_formatting(spark, sf_dir).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars) for r in rows} == {
        c: (len(t), brute.turns_digest(t), sum(len(x or "") for r, x in t if r == "assistant")) for c, t in turns.items()
    }


# -- benchmark --------------------------------------------------------------------------------------


def test_leaks_in_nasty_rows(spark, nasty, nasty_table):
    texts = [t for _, t in nasty if t]
    words = max(texts, key=len).split(" ")
    long = words[40:110]
    changed = [*long[:66], "CHANGED,", *long[67:]]
    items = [(1, " ".join(long).upper()), (2, " ".join(changed)), (3, "one"), (4, "never there at all, not once"), (5, None), (6, "..."), (7, "one two")]
    items += [(None, "one"), (8, " ".join(words[300:330]))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = decontamination.leaks(nasty_table.where("doc_id is not null"), benchmark).collect()
    known = [(i, t) for i, t in nasty if i is not None]
    wanted = brute.leaks(known, [(i, t) for i, t in items if t])
    assert {(r.doc_id, r.item_id): (r.similarity, r.start) for r in rows} == wanted
    assert {i for _, i in wanted} >= {1, 2, 3, 7, 8}
    left = decontamination.decontaminated(nasty_table.withColumnRenamed("kept", "leaks"), benchmark)
    assert left.columns == [*nasty_table.columns[:-1], "leaks"]
    bad = {d for d, _ in wanted} | {None}
    assert {r.doc_id for r in left.collect()} - {None} == {i for i, _ in nasty} - bad


def found_in(texts, items, settings=decontamination.Settings()):
    """As brute.leaks, by the operator's search of one group of items."""
    prepared = decontamination.Items(items, settings)
    found = prepared.find([decontamination.normal(t) for _, t in texts])
    return {(d, i): (s, at) for (d, _), leaks in zip(texts, found) for i, s, at in leaks}


def test_documents_shorter_than_the_item_leak():
    item = [f"w{i}" for i in range(37)]
    cuts = [item[:-1], item[1:], item[2:-2], item[:30], item[:31], item[:4], [*item[:20], "other", *item[20:-1]], item]
    texts = [(k, " ".join(c)) for k, c in enumerate(cuts)] + [(99, "")]
    items = [(1, " ".join(item)), (2, "w0 w1 w2 w3 w4 w5"), (3, "w0 w1 w2 w3 x")]
    found = found_in(texts, items)
    assert found == brute.leaks(texts, items)
    assert found[0, 1] == (32 / 33, 0) and {d for d, i in found if i == 1} == {0, 1, 2, 4, 7}


def test_leaks_just_above_the_similarity():
    """One end or both replaced up to the least similarity, and texts of two words, whose fingerprints are far."""
    rng = np.random.default_rng(11)
    say = lambda n: [f"v{k}" for k in rng.integers(0, 10**6, n)]
    items, texts = [], []
    for i, n in enumerate(rng.integers(13, 122, 200).tolist()):
        words, lost = say(n), (n - 4) // 9
        front = (0, lost, lost // 2)[i % 3]
        copy = [*say(front), *words[front : n - lost + front], *say(lost - front)]
        items.append((i, " ".join(words)))
        texts.append((i, " ".join(say(7) + copy + say(9)) if i % 2 else " ".join(copy)))
    items.append((1000, " ".join(["a", "b"] * 50 + ["a"])))
    texts.append((1000, " ".join(["b", "a"] * 50 + ["b"])))
    found = found_in(texts, items)
    assert len({i for _, i in found}) >= 200  # of 201; the chance to miss one at the radius is below 0.001
    near = found_in(texts, items, decontamination.Settings(radius=7))  # the fingerprints decide
    assert near.keys() < found.keys()
    assert {i for _, i in found_in(texts, items, decontamination.Settings(radius=-1))} == {1000}
    assert all(0.8 <= s < 0.9 for (_, i), (s, _) in found.items() if i < 1000)
    words = dict(items)
    same = 0
    for text in texts:  # items of one text have no words in common with the others
        same += {k: v for k, v in found.items() if k[0] == text[0]} == brute.leaks([text], [(text[0], words[text[0]])])
    assert same >= 199


def test_items_with_one_id_are_found_once(spark, monkeypatch):
    items = [(1, "w1 w2 w3 w4 w5 w6"), (1, "x1 x2 x3 x4 x5 x6"), (2, "y1 y2 y3 y4 y5 y6")]
    docs = spark.createDataFrame([(7, "w1 w2 w3 w4 w5 w6 x1 x2 x3 x4 x5 x6 y1 y2 y3 y4 y5 y6")], "doc_id long, text string")
    monkeypatch.setattr(decontamination, "GROUP_ITEMS", 1)
    rows = decontamination.leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.item_id, r.similarity, r.start) for r in rows) == [(1, 1.0, 0), (2, 1.0, 12)]


def test_benchmark_in_groups(spark, nasty_table, monkeypatch):
    items = [(i, f"w{i} w{i + 1}") for i in range(30)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    whole = decontamination.with_leaks(nasty_table, benchmark).select("row", "leaks")
    monkeypatch.setattr(decontamination, "GROUP_ITEMS", 7)
    parts = decontamination.with_leaks(nasty_table, benchmark)
    assert set(parts.columns) == set(nasty_table.columns) | {"leaks"}
    assert sorted(map(str, parts.select("row", "leaks").collect())) == sorted(map(str, whole.collect()))
    assert decontamination.leaks(nasty_table, benchmark.limit(0)).count() == 0
    assert decontamination.leaks(nasty_table.limit(0), benchmark).count() == 0


@pytest.mark.parametrize("group_items", [1000, 1])
def test_texts_are_searched_once(spark, monkeypatch, group_items):
    """One Python evaluation, however many groups there are and whatever is asked of its result."""
    items = [(1, "w1 w2 w3 w4 w5 w6"), (2, "x1 x2 x3 x4 x5 x6"), (3, "y1 y2 y3 y4 y5 y6")]
    rows = [(7, "y1 y2 y3 y4 y5 y6 w1 w2 w3 w4 w5 w6"), (8, "w1"), (9, None), (10, "x1 x2 x3 x4 x5 x6")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontamination, "GROUP_ITEMS", group_items)
    found = decontamination.with_leaks(docs, benchmark)
    listed = decontamination.leaks(docs, benchmark)
    for df in (listed, found.where("size(leaks) > 0"), decontamination.decontaminated(docs, benchmark)):
        assert df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert {r.doc_id: [tuple(x) for x in r.leaks] for r in found.collect()} == {7: [(1, 1.0, 6), (3, 1.0, 0)], 8: [], 9: [], 10: [(2, 1.0, 0)]}
    assert sorted(map(tuple, listed.collect())) == [(7, 1, 1.0, 6), (7, 3, 1.0, 0), (10, 2, 1.0, 0)]


def test_windows_meet_many_items_in_parts(monkeypatch):
    """Items that repeat themselves meet every window: the pairs held at once are bounded."""
    met = []
    candidates = decontamination.SizeClass.candidates
    monkeypatch.setattr(decontamination.SizeClass, "candidates", lambda c, prints, radius: met.append(len(prints) * len(c.ids)) or candidates(c, prints, radius))
    monkeypatch.setattr(decontamination, "PAIRS", 500, raising=False)
    items = [(i, " ".join(["a", "b"] * 15 + [f"c{i}"])) for i in range(9)]
    texts = [(1, " ".join(["b", "a"] * 300 + ["c4", "b", "a"])), (2, " ".join(["a", "b"] * 40))]
    assert found_in(texts, items) == brute.leaks(texts, items)
    assert len(met) > 1 and max(met) <= 500


def test_all_near_blocks_are_found():
    rng = np.random.default_rng(3)
    item = decontamination.SizeClass(9, decontamination.Settings())
    words = rng.integers(0, 2**63, 9, dtype=np.uint64)
    item.add(1, words)
    value = item.prints[0]
    flips = [sum(1 << int(k) for k in rng.choice(64, n, replace=False)) for n in range(20) for _ in range(50)]
    prints = np.array([value ^ f for f in flips], dtype=np.uint64)
    found = set(item.candidates(prints, 11)[0].tolist())
    assert found == {i for i, f in enumerate(flips) if f.bit_count() <= 11}


def test_leaks_query(spark, sf_dir, documents):
    items = [tuple(r) for r in table_of(spark, sf_dir, "benchmark").select("item_id", "text").collect()]
    # only items that share a shingle are compared at length
    rows = queries.op4_benchmark_decontamination(spark, sf_dir).collect()
    found = {(r.doc_id, r.item_id): (r.similarity, r.start) for r in rows}
    some = [i for i, _ in items][:6] + [i for _, i in found]
    wanted = brute.leaks(documents, [(i, t) for i, t in items if i in some])
    assert {k: v for k, v in found.items() if k[1] in some} == wanted and found


# -- packing ----------------------------------------------------------------------------------------


def encoded(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.tokenizer_path())
    return [e.ids + [packing.END] for e in t.encode_batch(list(texts), add_special_tokens=False)]


def check_packing(rows, docs, window):
    ids = {d: np.array(e, dtype="<u4") for (d, _), e in zip(docs, encoded(t or "" for _, t in docs))}
    at = Counter()
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        assert r.start == at[r.doc_id] and r.doc_tokens == len(ids[r.doc_id])
        at[r.doc_id] += r.length
        assert bytes(r.ids) == ids[r.doc_id][r.start : r.start + r.length].tobytes()
    assert at == Counter({d: len(i) for d, i in ids.items()})
    fill = Counter()
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fill[r.sequence_id]
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= window
    return sum(fill.values()) / (window * len(fill))


def test_packing_of_nasty_rows(spark, nasty, nasty_table):
    named = [(k, t) for k, (_, t) in enumerate(nasty)]
    renamed = nasty_table.drop("doc_id").withColumnRenamed("row", "doc_id")
    for window in (64, 2048):
        rows = packing.pack(renamed, queries.tokenizer_path(), window).collect()
        assert check_packing(rows, named, window) > 0.85
    assert packing.pack(nasty_table.limit(0), queries.tokenizer_path()).count() == 0
    assert packing.pack(nasty_table, queries.tokenizer_path()).where("doc_id is null").count() >= 2


def test_packing_query(spark, sf_dir, documents):
    rows = packing.pack(table_of(spark, sf_dir, "documents"), queries.tokenizer_path()).collect()
    assert check_packing(rows, documents, 2048) > 0.98
    crc = {(r.doc_id, r.start): zlib.crc32(bytes(r.ids)) for r in rows}
    assert {(r.doc_id, r.start): r.ids_crc32 for r in queries.op6_packing(spark, sf_dir).collect()} == crc


def test_added_tokens_and_pieces_as_the_library_gives_them():
    texts = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|> x<|endoftext|>", "<|endo<|endoftext|>ftext|>", "", "  \n x's 'tis ½ 字"]
    found = tokens.Encoder(queries.tokenizer_path()).encode(texts)
    assert [np.frombuffer(f, "<u4").tolist() + [packing.END] for f in found] == encoded(texts)


@pytest.mark.parametrize("shape", ["same", "small", "mixed", "one", "none"])
def test_plans_place_every_piece_once(shape):
    rng = np.random.default_rng(4)
    histogram = {
        "same": {1500: 100_003},
        "small": {n: int(rng.integers(1, 500)) for n in range(1, 40)},
        "mixed": dict(Counter(rng.integers(1, 2049, 30_000).tolist())),
        "one": {7: 1},
        "none": {},
    }[shape]
    lines = packing.plan(histogram, 2048)
    fill, covered = Counter(), Counter()
    for kind, first, end, start, used, sequence, offset in lines:
        covered[kind] += (end - first) * used
        for s in range(sequence, sequence + end - first):
            fill[s] += used
    assert covered == Counter({n: n * c for n, c in histogram.items()})
    assert max(fill.values(), default=0) <= 2048
    if sum(histogram.values()) > 1000:
        assert sum(fill.values()) / (2048 * len(fill)) > 0.99


def test_tokens_are_those_of_the_library():
    texts = ["", " a  b\n\n c", "it's we'll THEY'VE", "x²½Ⅷ½ 12３4", "a\x1cb\x1f c\x85d\xa0e", "日本語　三 ４", "🙂<|endoftext|> _x_ <|", "é" * 50 + "   ", "\t\r\n", "a b"]
    mine = [np.frombuffer(b, "<u4").tolist() + [packing.END] for b in tokens.Encoder(queries.tokenizer_path()).encode(texts)]
    assert mine == encoded(texts)


# -- quality and language ---------------------------------------------------------------------------


def test_rules_of_nasty_rows(spark, nasty, nasty_table, empty_table):
    for r in rules.quality_rules(nasty_table).collect():
        text = nasty[r.row][1]
        w = brute.words(text)
        windows = Counter(zip(w, w[1:], w[2:]))
        repeated = {j for i in range(len(w) - 2) if windows[w[i], w[i + 1], w[i + 2]] > 1 for j in (i, i + 1, i + 2)}
        lines = [x for x in (text or "").split("\n") if brute.words(x)]
        assert (r.n_words, r.n_repeat_words) == (len(w), len(repeated))
        assert r.word_chars == sum(len(x.decode()) for x in w)
        assert r.n_symbols == sum(c in "#*$%&|<>" for c in text or "")
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert r.base_failed == (len(w) < 50 or 100 * len(repeated) > 50 * len(w))
        assert not (r.kept and r.base_failed)
    assert rules.quality_rules(empty_table).count() == 0


def test_lines_that_fail():
    fails = lambda line: rules.line_fails(line, brute.words(line), rules.LineRules())
    for line in ["Home | About | Contact us", "THIS IS ALL VERY LOUD AND LONG", "a$$$ b%%% c***", "no! no! no!", "x x x x x x x", "All rights reserved.", "Click here to read more", "The story of a town that ...", "Und dann kam der Tag, an dem…  ", "Alle Rechte vorbehalten", "Lire la suite", "© Todos los derechos reservados", "Política de privacidad | Aviso legal"]:
        assert fails(line), line
    for line in ["A plain sentence about shells.", "NASA", "Sie las weiter, bis es dunkel wurde.", "He said ... nothing at all.", "We paid 5% | or so.", "The cookie that she baked for the long winter evenings was what they all remembered years later, when the house by the sea had long been sold to strangers."]:
        assert not fails(line), line
    loud = "BUY NOW BUY NOW AND NEVER STOP\n" * 3
    plain = " ".join(f"word{i}" for i in range(60))
    assert rules.judge(plain)[6] and rules.judge(plain + "\n" + loud)[6] and not rules.judge(loud + plain[:100])[6]
    assert rules.judge(plain + "\n" + loud)[9].strip() == plain


def test_rules_query_tells_labelled_junk(spark, sf_dir):
    found = queries.op7_quality_rules(spark, sf_dir).join(table_of(spark, sf_dir, "labels"), "doc_id").collect()
    assert all(not r.kept for r in found if r.quality == 0)
    assert all(r.kept or r.base_failed for r in found if r.quality == 1)


def test_ngrams_are_counted():
    row, bucket, count = ngrams.counts(["ab ab", "", "AB\tab"], 14, 2)
    one = dict(zip(bucket[row == 0].tolist(), count[row == 0].tolist()))
    assert one == dict(zip(bucket[row == 2].tolist(), count[row == 2].tolist()))
    # " ab ab ": 3 spaces, 2 a, 2 b; " a" 2, "ab" 2, "b " 2
    assert sorted(one.values()) == [2, 2, 2, 2, 2, 3]
    assert count[row == 1].tolist() == [2, 1]  # two spaces, one pair of them


def test_language_of_held_out_documents(spark, sf_dir, documents):
    rows = queries.op10_language_id(spark, sf_dir).join(table_of(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == len(documents)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(held) > 20 and sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_nasty_rows(spark, nasty, nasty_table, empty_table):
    rows = langid.language_id(nasty_table).collect()
    for r in rows:
        text = nasty[r.row][1] or ""
        assert r.lang_pred == ("en" if any(map(str.isalpha, text)) else "und")
    assert sorted(r.row for r in rows) == list(range(len(nasty)))
    assert langid.language_id(empty_table).count() == 0
    unlabelled = nasty_table.drop("lang").withColumnRenamed("shard", "lang").selectExpr("*").replace("keep", None, ["lang"])
    assert {r.lang_pred for r in langid.language_id(unlabelled).collect()} == {"und"}


def test_predictions_against_plain_arithmetic(spark):
    """Document frequencies, features and chances of a trained model, text by text."""
    import math
    import random

    rnd = random.Random(9)
    letters = {"aa": "abcdeéf", "bb": "bcdxyz", "cc": "aexyzñ"}
    say = lambda k, n: " ".join("".join(rnd.choices(letters[k], k=rnd.randrange(1, 7))) for _ in range(n))
    rows = [(say(k, rnd.randrange(1, 30)), k) for k in letters for _ in range(40)] + [("", "aa"), (None, "bb"), ("12 !", None)]
    settings = langid.Settings(bits=9)
    model = langid.train(spark.createDataFrame(rows, "text string, lang string").repartition(3), "text", "lang", settings)
    known = [t for t, k in rows if t is not None and k is not None]
    held = Counter(b for t in known for b in ngrams.counts([t], 9, 3)[1].tolist())
    idf = [math.log((1 + len(known)) / (1 + held[b])) + 1 for b in range(512)]
    assert model.idf.tolist() == pytest.approx(idf) and model.languages == ["aa", "bb", "cc"]
    texts = [say(k, 8) for k in letters] + ["xyz", "abc"] + [t for t, _ in rows[:20]]
    for text, name, score in zip(texts, *model.predict(texts)):
        _, bucket, count = ngrams.counts([text], 9, 3)
        value = [(1 + math.log(c)) * idf[b] for b, c in zip(bucket.tolist(), count.tolist())]
        norm = math.sqrt(sum(v * v for v in value))
        odds = [sum(v / norm * model.weights[b, k] for b, v in zip(bucket.tolist(), value)) + model.weights[-1, k] for k in range(3)]
        chances = [math.exp(o / model.temperature) for o in odds]
        best = max(range(3), key=lambda k: chances[k])  # noqa: B023
        assert (name, score) == (model.languages[best], pytest.approx(chances[best] / sum(chances)))


def test_only_the_most_frequent_languages_are_learned(spark):
    rows = [(f"{k} text {i}", k) for k, n in (("aa", 9), ("bb", 5), ("cc", 5)) for i in range(n)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    assert langid.train(docs, "text", "lang", langid.Settings(languages=2)).languages == ["aa", "bb"]


def test_copies_do_not_crowd_out_the_sample(spark):
    """Nine of ten rows are copies of a few texts; all different texts fit into the sample, or fill it."""
    rows = spark.range(20_000).selectExpr("'xx' as label", "if(id % 10 > 0, concat('copy ', id % 3), concat('text ', id)) as text")
    texts = [r.text for r in langid.sampled(rows, 2400).collect()]
    assert len(texts) == len(set(texts)) == 2003
    few = langid.sampled(rows, 300).collect()
    assert len({r.text for r in few}) == 300 and sorted(r.turn for r in few) == list(range(1, 301))


def test_temperature_is_sound():
    rng = np.random.default_rng(0)
    truth = rng.normal(0, 2, (4000, 3))
    labels = np.array([rng.choice(3, p=p) for p in langid.softmax(truth)])
    assert 3.4 < langid.fit_temperature(truth * 4, labels) < 4.7


def test_quality_of_labelled_documents(spark, sf_dir):
    found = queries.op9_quality_classifier(spark, sf_dir).join(table_of(spark, sf_dir, "labels"), "doc_id").collect()
    right = sum(r.accepted == (r.quality == 1) for r in found) / len(found)
    assert right > 0.9 and all(r.accepted for r in found if r.quality == 1 and r.score > 0.5)
    assert all(0 <= r.content_score <= 1 and 0 <= r.metadata_score <= 1 for r in found)


def test_quality_is_learned_for_documents_without_labels(spark):
    """Labels for a part, and junk that one view alone can tell."""
    import random

    rnd = random.Random(1)
    say = lambda n: " ".join("".join(rnd.choices("abcdefgh", k=rnd.randrange(2, 8))) for _ in range(n))
    rows = []
    for i in range(600):
        junk = i % 3 == 0
        text = " ".join(w + "%%" for w in say(60).split()) if junk else say(60) + ".\n" + say(40) + "."
        rows.append((i, text, "bad" if junk else f"s{i % 5}", "xx"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(i, int(i % 3 != 0)) for i in range(0, 60)], "doc_id long, quality int")
    found = cotraining.quality_classifier(docs, labels).collect()
    assert sum(r.accepted == (r.doc_id % 3 != 0) for r in found) > 590


def test_quality_with_an_id_repeated_many_times(spark):
    """One unlabelled id fills most of the table; the labelled ones still teach."""
    rows = [(-1, "lorem ipsum dolor sit amet.", "s", "xx")] * 20_000
    for i in range(60):
        bad = i % 2 == 0
        rows.append((i, ("%% $$ ## buy " * 20) if bad else f"A sentence of page {i}, with an end. " * 5, "s", "xx"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    found = cotraining.quality_classifier(docs, labels).where("doc_id >= 0").collect()
    assert sum(r.accepted == (r.doc_id % 2 == 1) for r in found) >= 58


def test_surest_against_brute_force(spark):
    """One round of picks: thresholds by source, one row an id, labelled ones left out, sources in turn."""
    rnd = np.random.default_rng(2)
    n = 3000
    source = np.where(rnd.random(n) < 0.9, "big", np.where(rnd.random(n) < 0.7, "small", "rare"))
    chance = np.round(rnd.beta(0.3, 0.3, (n, 2)), 4)
    rows = [(k, str(k // 2 if k < 200 else k), str(source[k]), float(chance[k, 0]), float(chance[k, 1])) for k in range(n)]
    scored = spark.createDataFrame(rows, "row long, id string, source string, chance0 double, chance1 double").repartition(3)
    labelled = {str(k) for k in range(0, 3000, 7)}
    given = spark.createDataFrame([(i, 1) for i in labelled], "id string, label int")
    settings = cotraining.Settings(pseudo=60)
    picked = [(r["view"], r.label, r.row) for r in cotraining.surest(scored, given, settings).collect()]
    assert len(picked) == len(set(picked))
    for v in (0, 1):
        quota = round(60 * float((chance[:, v] < 0.5).mean()))
        for label, most in ((0, quota), (1, 60 - quota)):
            able: dict[str, set[int]] = {}
            first: dict[str, int] = {}
            for name in set(source):
                own = np.sort(chance[source == name, v])
                at = lambda q: own[max(0, int(np.ceil(q * len(own))) - 1)]  # noqa: B023, E731
                low, high = min(at(0.05), 0.1), max(at(0.95), 0.9)
                for k in np.flatnonzero(source == name).tolist():
                    if (chance[k, v] <= low) if label == 0 else (chance[k, v] >= high):
                        first[rows[k][1]] = min(first.get(rows[k][1], k), k)
            for i, k in first.items():
                if i not in labelled:
                    able.setdefault(str(source[k]), set()).add(k)
            mine = [r for w, y, r in picked if (w, y) == (v, label)]
            assert set(mine) <= set().union(*able.values()) and len(mine) == min(most, sum(map(len, able.values())))
            assert all(any(r in able[name] for r in mine) for name in able)  # the rare source too


def test_quality_of_nasty_rows(spark, nasty, nasty_table, empty_table):
    labels = spark.createDataFrame([(40, 1), (41, 1), (6, 0), (7, 0), (6, None), (None, 1)], "doc_id long, quality int")
    rows = cotraining.quality_classifier(nasty_table, labels).collect()
    assert sorted(r.row for r in rows) == list(range(len(nasty)))
    for r in rows:
        if not brute.words(nasty[r.row][1]):
            assert r.score == 0 and not r.accepted
    none = cotraining.quality_classifier(nasty_table, labels.limit(0)).collect()
    assert all(r.accepted == bool(brute.words(nasty[r.row][1])) for r in none)
    assert cotraining.quality_classifier(empty_table, labels).count() == 0
