"""Quality counts, n-gram join, line dedup, decontamination, chat and URLs against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from layercake.llm import chat_format, decontaminate, line_dedup, ngram_join, quality_rules, url_filter
from layercake.llm.scratch import Scratch

random.seed(11)
WORDS = [f"w{i}" for i in range(12)]
LINES = [" ".join(random.choice(WORDS) for _ in range(random.randint(1, 6))) for _ in range(20)] + ["", " "]
TEXTS = ["\n".join(random.choice(LINES) for _ in range(random.randint(0, 25))) for _ in range(60)] + [None, "", "a", "A\t# é É"]
ROWS = list(enumerate(TEXTS))
CLASH = "doc_id long, text string, kept string, n_words string, component_id string, deleted string, items string"


def frame(spark, rows=ROWS):
    return spark.createDataFrame([(d, t, "x", "x", "x", "x", "x") for d, t in rows], CLASH)


def test_counts(spark):
    got = {r.doc_id: r for r in quality_rules.quality_rules(frame(spark)).collect()}
    for d, t in ROWS:
        ws = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        windows = [tuple(ws[i : i + 3]) for i in range(len(ws) - 2)]
        n, covered = Counter(windows), set()
        for i, w in enumerate(windows):
            if n[w] > 1:
                covered |= {i, i + 1, i + 2}
        lines = [x for x in (t or "").split("\n") if x.strip()]
        r = got[d]
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(ws), sum(map(len, ws)), len(covered))
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert r.base_failed == (len(ws) < 50 or 100 * len(covered) > 50 * len(ws))


def test_rule_order_never_changes_the_verdict(spark):
    counted = quality_rules.with_counts(frame(spark))
    one = quality_rules.cascade(counted, quality_rules.RULES).select("doc_id", "kept")
    other = quality_rules.cascade(counted, quality_rules.RULES[::-1]).select("doc_id", "kept")
    assert sorted(one.collect()) == sorted(other.collect())


def components_of(rows, n, percent):
    sets = {}
    for d, t in rows:
        ws = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        sets[d] = {tuple(ws[i : i + n]) for i in range(len(ws) - n + 1)} if len(ws) >= n else {tuple(ws)} if ws else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(sets[d]), find(d)) for d in sets}


@pytest.mark.parametrize("changes", [1, 2, 3])
def test_many_versions_of_one_text(spark, changes):
    """All share rare n-grams with all others, and about as many pairs are links as are just not."""
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(90):
        ws = list(base)
        for at in random.sample(range(len(ws)), changes):
            ws[at] = f"c{random.randrange(40)}"
        rows.append((i, " ".join(ws[random.choice([0, 0, 5]) :])))
    got = ngram_join.ngram_components(frame(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == components_of(rows, 4, 85)


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80)])
def test_ngram_components(spark, n, percent):
    base = [[random.choice(WORDS) for _ in range(50)] for _ in range(4)]
    rows = [(i, " ".join(random.choice(WORDS) if random.random() < 0.02 else w for w in random.choice(base))) for i in range(120)]
    rows += [(500 + i, t) for i, t in enumerate([None, "", "a b", "A b", rows[0][1], rows[0][1].upper()])]
    got = ngram_join.ngram_components(frame(spark, rows + rows[:2]), ngram_join.Similarity(n, percent)).collect()
    assert len(got) == len(rows) + 2
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == components_of(rows, n, percent)


@pytest.mark.parametrize(("words", "changes", "barren"), [(120, 5, 3), (640, 22, 0)])
def test_texts_of_one_template(spark, monkeypatch, words, changes, barren):
    """Most pairs miss the threshold by little; long sets meet in more lists than are looked back on."""
    monkeypatch.setattr(ngram_join, "BARREN", barren)
    rows = []
    for i in range(40):
        ws = [f"t{j}" for j in range(words)]
        for at in random.sample(range(0, words, 5), random.randint(changes - 3, changes + 1)):
            ws[at] = f"c{at}x{random.randrange(2)}"
        rows.append((i, " ".join(ws[: random.choice([words, words, words - 9])])))
    got = ngram_join.ngram_components(frame(spark, rows)).collect()
    wanted = components_of(rows, 4, 85)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == wanted
    assert len({c for _, c in wanted.values()}) > 1


def test_rounds_of_hubs_do_not_grow_with_the_rows(spark, monkeypatch):
    """With more texts, each round finds a link or two more; what is left is compared pair by pair all the same."""
    opened, put = [], Scratch.put
    monkeypatch.setattr(Scratch, "put", lambda self, df, name: opened.append(name) or put(self, df, name))
    rows, chance = [], random.Random(5)
    for t in range(12):
        for _ in range(24):
            ws = [f"t{t}x{j}" for j in range(120)]
            for at in chance.sample(range(0, 120, 5), chance.randint(2, 6)):
                ws[at] = f"c{t}x{at}x{chance.randrange(2)}"
            rows.append((len(rows), " ".join(ws)))
    got = ngram_join.ngram_components(frame(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == components_of(rows, 4, 85)
    assert opened.count("open") <= 4


@pytest.mark.parametrize("percent", [50, 80, 85, 100])
def test_similar_sizes_are_in_bands_side_by_side(spark, percent):
    like = ngram_join.Similarity(4, percent)
    sizes = spark.range(1, 1100).select(like.band(F.col("id")).alias("band")).collect()
    for a in range(1, 1100):
        for b in range(a, min(1099, 100 * a // percent) + 1):
            assert 0 <= sizes[b - 1].band - sizes[a - 1].band <= 1


@pytest.mark.parametrize("copies", [1, 2, 3])
def test_repeated_rows_keep_their_links(spark, copies):
    """Pairs of 20 n-grams that share 19: all n-grams of a pair are in the same two documents."""
    rows = []
    for i in range(6):
        ws = [f"p{i}x{j}" for j in range(23)]
        rows += [(2 * i, " ".join(ws)), (2 * i + 1, " ".join([*ws[:-1], "other"]))]
    got = ngram_join.ngram_components(frame(spark, rows * copies)).collect()
    assert len(got) == len(rows) * copies
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == components_of(rows, 4, 85)


def test_ids_of_several_texts_are_one_node(spark):
    base = [[random.choice(WORDS) for _ in range(40)] for _ in range(12)]
    rows = [(random.randrange(40), " ".join(random.choice(WORDS) if random.random() < 0.02 else w for w in random.choice(base))) for _ in range(60)]
    alone = components_of(list(enumerate(t for _, t in rows)), 4, 85)
    root = {d: d for d, _ in rows}
    for _ in rows:  # the smallest id among all rows of an id and all rows of a component, until nothing moves
        for group in ([alone[i][1] for i in range(len(rows))], [d for d, _ in rows]):
            for g in set(group):
                ids = [rows[i][0] for i in range(len(rows)) if group[i] == g]
                least = min(root[d] for d in ids)
                root.update({d: least for d in ids})
    got = ngram_join.ngram_components(frame(spark, rows + rows[::2])).collect()
    assert len(set(root.values())) > 1
    assert {r.doc_id: r.component_id for r in got} == root and {(r.doc_id, r.component_id) for r in got} == set(root.items())


def deleted_of(rows, least):
    seen, gone = {}, {}
    docs = [(d, [x.strip() for x in (t or "").split("\n") if x.strip()]) for d, t in sorted(rows)]
    for x, (d, mine) in enumerate(docs):
        gone[d] = set()
        for i, line in enumerate(mine):
            for y, j in seen.get(line, []):
                k = n = 0
                while i + k < len(mine) and j + k < len(docs[y][1]) and mine[i + k] == docs[y][1][j + k]:
                    n += len(mine[i + k].split())
                    k += 1
                if n >= least:
                    gone[d] |= set(range(i, i + k))
            seen.setdefault(line, []).append((x, i))
    return gone


@pytest.mark.parametrize("least", [3, 12])
def test_line_runs(spark, least):
    rows = [(i, t) for i, t in ROWS] + [(100, "a b\n" * 30), (101, "a b\n" * 30)]
    want = deleted_of(rows, least)
    for r in line_dedup.dedup_lines(frame(spark, rows), least).collect():
        text = dict(rows)[r.doc_id]
        lines = (text or "").split("\n")
        gone = {i for x in r.deleted for i in range(x.first, x.last + 1)}
        places = [i for i, x in enumerate(lines) if x.strip()]
        assert {k for k, i in enumerate(places) if i in gone} == want[r.doc_id]
        assert r.text == (None if text is None else "\n".join(x for i, x in enumerate(lines) if i not in gone))


def test_decontamination(spark):
    items = [(1, " ".join(f"t{i}" for i in range(20))), (2, "Short one!"), (3, None), (None, "x y z")]
    rows = [(1, "a " * 50 + " ".join(f"T{i}," for i in range(3, 18))), (2, "it is SHORT-one"), (3, None), (4, ""), (5, "short x one"), (None, "short one")]
    got = {r.doc_id: r for r in decontaminate.decontaminate(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert (got[1].n_words, got[1].n_hit, got[1].items) == (65, 15, ["1"])
    assert (got[2].n_hit, got[2].items, got[2].contaminated) == (2, ["2"], True)
    assert [got[d].n_hit for d in (3, 4, 5, None)] == [0, 0, 0, 2]
    empty = spark.createDataFrame([], "item_id long, text string")
    assert all(r.n_hit == 0 for r in decontaminate.decontaminate(frame(spark, rows), empty).collect())


def test_proximity(spark):
    items = spark.createDataFrame([(1, "alpha beta")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "beta x alpha"), (2, "alpha " + "x " * 20 + "beta"), (3, None)], "doc_id long, text string")
    assert [tuple(r) for r in decontaminate.proximity_matches(docs, items, 4).collect()] == [(1, "1", 1)]


def test_chat_round_trip(spark):
    parts = ["<", "|", "\\", "turn", ">", "[", "INST]", "/s>", "<SYS>>", "a", "\n", "é"]
    rows = [(c, t, random.choice(["user", "assistant", None, "<|turn|>"]), "".join(random.choice(parts) for _ in range(random.randint(0, 12))) or None) for c in range(40) for t in range(3)]
    made = chat_format.chat_format(chat_format.turns_from_rows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    back = made.withColumns({"back": chat_format.read_turns(made["formatted"]), "loss": chat_format.read_loss_text(made["formatted"], made["loss_spans"])})
    for r in back.collect():
        assert r.back == r.turns
        assert r.loss == "".join(t.text for t in r.turns if t.role == "assistant")


def test_chat_layouts(spark):
    records = ['{"messages":[{"role":"user","content":"a"}]}', '{"prompt":"p","response":"r"}', '{"instruction":"i","input":"n","output":"o"}', '{"other":1}', None, "[1"]
    got = chat_format.turns_from_records(spark.createDataFrame([(r,) for r in records], "j string"), "j").collect()
    assert [r.layout for r in got] == ["messages", "prompt_response", "instruction_input", None, None, None]
    assert [t.text for t in got[2].turns] == ["i\n\nn", "o"]
    with pytest.raises(ValueError, match="no layout"):
        chat_format.turns_from_rows(spark.createDataFrame([(1,)], "x int"))


def test_chat_nested_records(spark):
    parts = '{"messages":[{"role":"human","content":[{"type":"text","text":"a"},{"type":"text","text":"b"}]},{"role":"bot","content":[]}]}'
    known = [parts, '{"messages":[]}', '{"prompt":5,"response":null}', '{"conversations":[{"from":"gpt","value":"v"}]}']
    unknown = [
        '{"messages":[{"role":"user","content":{"text":"a"}}]}',
        '{"messages":[{"role":"user","content":"a"},{"role":"user","content":[{"type":"text","text":"b"}]}]}',
        '{"messages":[{"role":"user","content":[{"type":"text","text":"a","more":{"deep":[1]}}]}]}',
        '{"messages":[{"role":"user","content":"a"}],"extra":{"id":1}}',
        '{"messages":["a"]}', '{"prompt":["p"],"response":"r"}', '{"prompt":"p","prompt":"q","response":"r"}', "", "[]", "3", '{"a":' * 400 + "1" + "}" * 400,
    ]
    df = spark.createDataFrame([(i, r, "x", "y") for i, r in enumerate(known + unknown)], "i int, j string, turns string, layout string")
    got = chat_format.turns_from_records(df, "j").orderBy("i").collect()
    assert [r.layout for r in got] == ["message_parts", "no_messages", "prompt_response", "from_value"] + [None] * len(unknown)
    assert [[tuple(t) for t in r.turns] for r in got[:4]] == [[("user", "a\nb"), ("assistant", "")], [], [("user", "5")], [("assistant", "v")]]
    assert all(r.turns is None for r in got[4:])
    empty = chat_format.chat_format(chat_format.turns_from_records(df.limit(0), "j"))
    assert empty.collect() == []


def test_chat_rows_by_fingerprint(spark):
    layouts = {
        "rows": ("conv_id long, turn int, role string, text string", lambda t, r, x: (1, t, r, x)),
        "from_rows": ("conversation_id string, turn int, `from` string, value string", lambda t, r, x: ("c", t, r, x)),
        "message_rows": ("conversation_id long, turn int, message struct<role:string,content:string>", lambda t, r, x: (1, t, (r, x))),
    }
    for name, (schema, row) in layouts.items():
        given = [row(1, "assistant", "b"), row(0, "user", "a"), row(1, "assistant", "b"), row(None, "user", None)]
        df = spark.createDataFrame([(*r, "x", "y") for r in given], schema + ", extra string, formatted string")
        assert chat_format.row_layout(df.schema).name == name
        made = chat_format.turns_from_rows(df).collect()
        assert [[tuple(t) for t in r.turns] for r in made] == [[("user", ""), ("user", "a"), ("assistant", "b"), ("assistant", "b")]]
        assert chat_format.turns_from_rows(df.limit(0)).collect() == []
    nested = spark.createDataFrame([], "conv_id long, turn int, role string, text struct<a:string>")
    with pytest.raises(ValueError, match="no layout"):
        chat_format.turns_from_rows(nested)


def test_chat_long_text(spark):
    text = "<|end|> [INST] é" * 40_000
    df = spark.createDataFrame([(1, 0, "assistant", text)], "conv_id long, turn long, role string, text string")
    made = chat_format.chat_format(chat_format.turns_from_rows(df))
    back = made.select(chat_format.read_turns(made["formatted"]).alias("t"), chat_format.read_loss_text(made["formatted"], made["loss_spans"]).alias("l")).first()
    assert back.t[0].text == text and back.l == text


def test_urls(spark):
    urls = ["https://WWW.example.com/en/1", "http://a.example.com/en/", "x://b.net/fr/2?q", "http://spam-farm.x.org/z", "http://com", "nothing", None, ""]
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, verdict string")
    got = {r.page_id: (r.host, r.pattern, r.verdict) for r in url_filter.judge(df, url_filter.RULES).collect()}
    assert got[0] == ("www.example.com", "||www.example.com/en/", "allow")
    assert got[1][1:] == ("||example.com/en/", "block")
    assert got[2][1:] == ("||net/fr/", "block")
    assert got[3][1:] == ("||spam-farm.", "block")
    assert [got[i][1:] for i in (4, 5, 6, 7)] == [(None, "allow")] * 4


def test_many_rules_as_a_plain_loop(spark):
    """10,000 generated rules of all forms, with ties and repeated URLs."""
    rules, urls = [], ["http://", "no scheme", None, "x:///"]
    for i in range(10_000):
        host, path = f"h{i % 700}.d{i % 90}.org", f"/p{i % 40}/q{i % 1100}"
        forms = [f"||{host}^", f"||d{i % 90}.org{path}", f"|{host}{path}|", f"{path}/*.html|", f"*q{i}*", f"/p{i % 40}^"]
        rules.append(url_filter.Rule(forms[i % 6 if i % 6 < 5 or i < 30 else 3], "block" if i % 7 < 4 else "allow", i % 3))
    for i in range(300):
        at = random.randrange(10_000)
        urls.append(f"https://{random.choice(['', 'www.'])}H{at % 700}.d{at % 90}.org/p{at % 40}/q{at % 1100}{random.choice(['', '/a.html', '/b', '?x=1'])}")
    urls += urls[:50]
    compiled = [(r, re.compile(url_filter.regex_of(r.pattern))) for r in rules]
    got = url_filter.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules).collect()
    assert len(got) == len(urls)
    fitted = 0
    for row in got:
        m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", urls[row.page_id] or "")
        subject = m[1].lower() + m[2] if m else ""
        fits = [(r.priority, len(r.pattern), r.pattern, r.verdict) for r, regex in compiled if regex.search(subject)]
        best = max(fits, default=(0, 0, None, "allow"))
        assert (row.pattern, row.verdict) == best[2:], urls[row.page_id]
        fitted += bool(fits)
    assert fitted > 100


def test_rule_tokens():
    assert url_filter.tokens_of("||ads.") == ["ads"]
    assert url_filter.tokens_of("/ad*s/") == [""]
    assert url_filter.tokens_of("||example.com/en/") == ["example", "com", "en"]


def test_empty_tables(spark):
    none = frame(spark, [])
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert quality_rules.quality_rules(none).count() == 0
    assert ngram_join.ngram_components(none).count() == 0
    assert line_dedup.dedup_lines(none).count() == 0
    assert decontaminate.decontaminate(none, items).count() == 0


def test_runs_of_repeated_rows_grow_with_the_rows(spark, tmp_path):
    """Copies of a row are one document: nothing is deleted from them, and other documents lose their run as before."""
    line = " ".join(f"w{i}" for i in range(60))
    rows = [(5, f"own\n{line}\n{line} x")] * 40 + [(None, f"{line}\nnull")] * 3 + [(9, f"other\n{line}\nend")] * 2
    seen = []
    put = line_dedup.Scratch.put

    def counting(self, df, name):
        made = put(self, df, name)
        if name == "runs":
            seen.append(made.count())
        return made

    line_dedup.Scratch.put = counting
    try:
        got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    finally:
        line_dedup.Scratch.put = put
    texts = {(r.doc_id, r.text) for r in got}
    assert len(got) == 45 and seen[0] < 20
    assert texts == {(None, f"{line}\nnull"), (5, f"own\n{line} x"), (9, "other\nend")}


def test_rounds_are_read_in_one_scan(spark):
    scratch = Scratch(spark, "rounds")
    for a in range(5):
        every = scratch.put_all(spark.createDataFrame([(a, a + 1)], "a long, b long"), "links")
    assert sorted(map(tuple, every.collect())) == [(a, a + 1) for a in range(5)]
    plan = every._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and plan.count("Relation") == 1
