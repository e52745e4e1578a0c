"""Quotation linking against a plain reading of the same rules."""

import random
import re
import time

import pytest

from tillwise.llm import common, quotes


def normal(x):
    return re.sub(r"[\W_]+", " ", x.lower()).strip()


def passages(text):
    out = []
    for line in re.split("\r?\n", text or ""):
        mark = re.match(r"(?:>[ \t]?)*", line)[0]
        level = mark.count(">")
        if not out or out[-1][0] != level:
            out.append((level, []))
        out[-1][1].append(line[len(mark):])
    return out


def body_of(parts):
    return "\n".join("\n".join(p) for level, p in parts if level == 0).strip()


def brute(rows):
    """rows: distinct (conversation, position, role, text)."""
    nodes, own = {}, {}
    for c, p, _, t in rows:
        if c is None or p is None:
            continue
        parts = passages(t)
        body = body_of(parts)
        units = [body, *("\n".join(x) for level, x in parts if level == 0), *re.split(r"\n\s*\n", body), *body.split("\n")]
        own.setdefault((c, p), set()).update(u for u in map(normal, units) if u)
        nodes.setdefault((c, p), []).append(parts)
    info = {}
    for (c, p), texts in nodes.items():
        quoted, linked = set(), {}
        for parts in texts:
            for n, (level, said) in enumerate(parts):
                if not level:
                    continue
                quoted.add((n, level))
                for kind, key in enumerate((normal("\n".join(said)), max((len(normal(s)), normal(s)) for s in said)[1])):
                    holders = [q for (d, q), units in own.items() if d == c and key and key in units]
                    if holders and min(holders) < p:
                        linked[n, level] = min(linked.get((n, level), (kind, min(holders))), (kind, min(holders)))
        best = max(((-level, source) for (n, level), (_, source) in linked.items()), default=None)
        info[c, p] = (best and best[1], len(quoted), len(linked))
    out = []
    for c, p, role, t in rows:
        parent, n, k = info.get((c, p), (None, 0, 0))
        root, depth, at = p, 0, parent
        while at is not None:
            root, depth, at = at, depth + 1, info[c, at][0]
        out.append((c, p, role, body_of(passages(t)), parent, root, depth, n, k, [root, depth, p]))
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame([(*r, 5) for r in rows], "conv long, at long, role string, text string, position int")
    return sorted((tuple(r) for r in quotes.messages(df, "conv", "at", "role", "text").collect()), key=str)


def test_nested_quotes(spark):
    rows = [(1, 0, "a", "First point.\n\nSecond point here."),
            (1, 1, "b", "> first POINT\nI agree."),
            (1, 2, "c", ">> First point.\n> I agree!\nMe too."),
            (1, 3, "a", "> Second point here.\nOn this.\n> Me too\nThanks"),
            (1, 4, "a", "> words nobody said\nHm"), (1, 5, "a", ">\n> \nempty quotes"),
            (1, 6, "b", "> no such line\n> second point here.\nby its longest line"),
            (2, 1, "x", "> First point.\nother conversation"), (2, 0, None, None), (2, 2, "y", ""),
            (None, 3, "z", "> a\nb"), (3, None, "z", "> a\nb"), (3, 1, "z", "a\r\n> a\r\n"), (3, 0, "u", "later"),
            (4, 5, "u", "same"), (4, 5, "v", "same two"), (4, 7, "w", "> same two\nok")]
    got = run(spark, rows + rows[:3])
    assert got == brute(rows)
    parents = {(r[0], r[1]): r[4] for r in got}
    assert parents[1, 1] == 0 and parents[1, 2] == 1 and parents[1, 3] == 2 and parents[1, 4] is None and parents[1, 6] == 0


def test_long_chain_and_common_line(spark):
    rows = [(1, i, "r", f"own words {i}\n> own words {i - 1}\n> hello\nhello") for i in range(70)]
    got = run(spark, rows)
    assert got == brute(rows)
    assert max(r[6] for r in got) > 30


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_threads(spark, seed):
    rng = random.Random(seed)
    rows = set()
    for c in range(6):
        said = []
        for p in range(rng.randrange(1, 12)):
            lines = [rng.choice(["", "> ", ">> ", "> > "]) + rng.choice(said + ["Alpha, beta", "gamma", "", "Ça va?"])
                     for _ in range(rng.randrange(1, 5))]
            said += [line for line in lines if not line.startswith(">")]
            rows.add((c, p, "r", "\n".join(lines)))
    rows = sorted(rows)
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_no_python_on_the_path(spark):
    table = common.table(common.prepare(spark), "/root/testdata/sf0.001", "conversations")
    plan = quotes.messages(quotes.mailbox(table), "conv_id", "turn", "role", "text")
    assert not re.search("Python|Pandas|Arrow", plan._jdf.queryExecution().executedPlan().toString())


def test_mailed_turns_reply_to_the_turn_before(spark):
    table = common.table(common.prepare(spark), "/root/testdata/sf0.001", "conversations")
    got = quotes.messages(quotes.mailbox(table), "conv_id", "turn", "role", "text")
    joined = got.join(table.selectExpr("conv_id as conversation", "turn as position", "trim(text) as said"),
                      ["conversation", "position"]).collect()
    assert len(joined) == table.count()
    assert all(r.body == r.said.strip() for r in joined)
    assert all((r.parent is None) == (r.position == 0) for r in joined)


def test_many_lines_take_time_in_proportion(spark):
    def seconds(n):
        best = None
        for _ in range(2):
            text = "\n".join(("> said %d" if i % 2 else "line %d") % i for i in range(n))
            df = spark.createDataFrame([(1, 0, "r", text)], "conv long, at long, role string, text string")
            start = time.perf_counter()
            row = quotes.keyed(quotes.parse(df, "conv", "at", "role", "text")).first()
            best = min(best or 1e9, time.perf_counter() - start)
            assert len(row.quotes) == n // 2 and row.body.count("\n") == n // 2 - 1
        return best

    # Eight times the lines: the square would take 64 times as long.
    small = seconds(8_000)
    assert seconds(64_000) < 16 * small


def test_long_texts(spark):
    rows = [(1, 0, "a", "> " * 50_000 + "x\nown"), (1, 1, "b", "\n" * 200_000 + "y" + " " * 200_000 + "z\n" + "\n" * 1000),
            (1, 2, "c", "> own\n" + "word " * 100_000)]
    got = run(spark, rows)
    assert got == brute(rows) and got[2][4] == 0
