import random
import re

from pyspark.sql import functions as F

from tidecart.llm import line_templates as lines


def test_recurring_templates_go_and_their_first_line_stays(spark):
    notice = "Contact us at {} for details about this site today"
    rng = random.Random(1)
    prose = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(12))
    texts = {}
    for i in range(10):
        texts[i] = [prose(), notice.format(f"mail{i}@x.org"), prose(), "short line here", f"Seen {i} times on the wiki page", prose()]
    texts[10] = [prose()]
    texts[11] = list(texts[0])  # a copy
    texts[12] = list(texts[0])
    docs = spark.createDataFrame([(i, "\n".join(t)) for i, t in texts.items()] + [(20, None), (21, ""), (22, "\n\n")], "doc_id long, text string")
    got = {r.doc_id: r for r in lines.without_boilerplate(docs).collect()}
    assert got[0].text == "\n".join(texts[0])
    for i in range(1, 10):
        assert got[i].text.split("\n") == [texts[i][j] for j in (0, 2, 3, 5)]
        assert (got[i].n_lines, got[i].n_dropped) == (6, 2)
    assert got[10].text == texts[10][0]
    assert got[11].text == got[12].text == "short line here"
    assert (got[20].text, got[20].n_lines, got[21].text, got[21].n_lines, got[22].text, got[22].n_lines) == (None, 0, "", 1, "\n\n", 3)


def test_odd_rows(spark):
    line = "one two three four five six seven"
    rows = [(None, line, 1), (1, line, 1), (1, line, 1), (2, f"{line}\n{line}", 2), (2, line, 3), (3, f"  {line}  ", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_lines int")
    got = lines.without_boilerplate(docs)
    assert got.columns == ["doc_id", "text", "n_lines", "n_dropped"]
    assert sorted((str(r.doc_id), r.text) for r in got.collect()) == [
        ("1", ""), ("1", ""), ("2", ""), ("2", ""), ("3", ""), ("None", line)]
    assert lines.without_boilerplate(docs.limit(0)).count() == 0


def test_a_very_long_text(spark):
    text = "\n".join(f"line {i} holds a few words and ends" for i in range(60_000))
    docs = spark.createDataFrame([(i, text) for i in range(3)], "doc_id long, text string")
    got = {r.doc_id: r for r in lines.without_boilerplate(docs).collect()}
    assert got[0].text == "line 0 holds a few words and ends" and got[1].text == "" and got[2].n_dropped == 60_000


def test_both_ways_to_the_candidates_agree(spark, monkeypatch):
    rng = random.Random(9)
    pool = [[rng.choice("abcdef") * 3 for _ in range(9)] for _ in range(6)]
    rows = []
    for i in range(60):
        own = [list(rng.choice(pool)) for _ in range(3)]
        for line in own:
            line[rng.randrange(9)] = rng.choice(["abc", "7x", "ddd"])
        rows.append((i if i % 7 else None, "\n".join(" ".join(x) for x in own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    one = sorted(map(str, lines.without_boilerplate(docs).collect()))
    monkeypatch.setattr(lines, "BROADCAST_BYTES", -1)
    assert one == sorted(map(str, lines.without_boilerplate(docs).collect()))
    assert any("n_dropped=3" in x for x in one)


def test_very_long_lines(spark):
    line = " ".join(f"word{chr(97 + i % 26)}" for i in range(300_000))
    other = line.replace("wordb", "other", 1)
    docs = spark.createDataFrame([(i, line) for i in range(3)] + [(9, other)], "doc_id long, text string")
    got = {r.doc_id: r.n_dropped for r in lines.without_boilerplate(docs).collect()}
    assert got == {0: 0, 1: 1, 2: 1, 9: 0}


def by_hand(texts, min_tokens=6, depth=3, least=3, percent=70):
    """(document, line number) of the lines to drop, by the rule itself."""
    at = {}
    for i, text in texts.items():
        for k, line in enumerate(text.split("\n")):
            tokens = tuple("<*>" if any(c.isdigit() for c in t) else t for t in line.split(" ") if t)
            if len(tokens) >= min_tokens:
                at[i, k] = tokens
    seen = {}
    for i, tokens in {(i, t) for (i, _), t in at.items()}:
        for p, t in enumerate(tokens):
            key = (len(tokens), tokens[:depth], p, t)
            seen[key] = seen.get(key, 0) + 1
    found = {}
    for where, x in at.items():
        stays = [p < depth or (t != "<*>" and seen[len(x), x[:depth], p, t] >= least) for p, t in enumerate(x)]
        constant = sum(s and t != "<*>" for s, t in zip(stays, x))
        if any(stays[depth:]) and constant * 100 >= len(x) * percent:
            found.setdefault((len(x), *[t if s else "<*>" for s, t in zip(stays, x)]), []).append(where)
    return {w for g in found.values() if len({i for i, _ in g}) >= least for w in g if w != min(g)}


def test_a_field_in_each_of_three_quarters(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(7))
    texts = {i: f"This page was {word()} by staff {word()} for the {word()} site archive" for i in range(200)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {(r.doc_id, r.n_dropped) for r in lines.without_boilerplate(docs).collect()}
    assert len(by_hand(texts)) == 199
    assert got == {(i, int(i > 0)) for i in range(200)}


def test_all_templates_of_the_rule_are_found(spark):
    rng = random.Random(11)
    texts = {}
    for i in range(150):
        own = []
        for _ in range(3):
            n = rng.choice([6, 7, 10, 13, 20])
            line = ["the", "first", "part"] + [f"w{'abcdefghijklmnopqrst'[p]}" for p in range(3, n)]
            for p in rng.sample(range(3, n), rng.randint(0, (3 * n) // 10 + 1)):
                line[p] = rng.choice(["x", "y", "z", "7", "".join(rng.choice("abcdefgh") for _ in range(6))])
            own.append(" ".join(line))
        texts[i] = "\n".join(own)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {(r.id, r.line_no) for r in lines.boilerplate(docs).collect()}
    assert got == by_hand(texts) and len(got) > 100


def test_blanks_and_digits_in_tokens(spark):
    texts = ["a b1 c", " a  b ", "", "   ", "1", "x12y  z\t7 é9é 日本5 😀 😀5 a😀", "-1 --", "<*> 2", "a\u00a0 1"]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, line string")
    plain = lines.single_blanks(F.col("line"))
    got = [tuple(r) for r in rows.select(plain, lines.masked(plain)).orderBy("i").collect()]
    tokens = [[t for t in x.split(" ") if t] for x in texts]
    assert got == [(" ".join(t), " ".join("<*>" if re.search("[0-9]", x) else x for x in t)) for t in tokens]


def test_no_text_is_cut_within_a_lambda(spark):
    docs = spark.createDataFrame([(i, f"one two three four five six seven\nown {i}") for i in range(4)], "doc_id long, text string")
    plan = lines.without_boilerplate(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction" in plan and not re.search(r"lambdafunction\([^\n]*split\(", plan)
