"""How far the sources of a language use its words differently, and by which words.

The vocabulary of all languages is one sorted list of keys (language, a zero byte, term). It is cut
into runs of at most ``SHARD_TERMS`` terms or ``SHARD_BYTES`` bytes, and of each run a minimal acyclic
transducer is built, state by state as the sorted terms come in: it accepts the run's keys and gives
each its lexicographic ordinal, the sum of the outputs on its way. The texts are then read again and
streamed through the transducers: a task adds up the terms of its documents per language and source,
sends them to the transducer of their range, which walks all terms of a message side by side, byte by
byte, and counts them under their ordinals; terms that it does not accept were not kept. Ordinals then
stand for the terms: they break ties and cut the vocabulary into blocks.

A transducer and its messages meet in one partition, sorted so that the transducer comes first, and
are streamed; a much used one is met in many partitions. So memory is bounded by one transducer and
one message, at any size of vocabulary or text. Only the first key of each run reaches the driver.

All arithmetic is on integers. Divergences of pairs of sources are summed per block of terms, so many
that sources times terms stay below ``CELLS``; the result itself has all pairs of a language.

Defined results: null texts, languages and sources are empty; documents are rows, so repeated ones
count as often as they come; groups without terms are given too, with no kept term all pairs are 0; an
empty table gives no rows. A very long text is cut at word ends into parts of ``PART`` bytes, none of
which is left out; a very long term is a term. Other columns of the table are not looked at. Counts
stay exact up to 9e15 words of a language.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tillwise.llm import common
from tillwise.operators.skew import join_per_key

LEAST_DOCUMENTS, TOP = 10, 10
SHARD_TERMS, SHARD_BYTES = 1 << 16, 1 << 22
# Bytes of a text looked at at once; distinct terms a task holds; bytes of a message.
PART, HELD, MESSAGE = 1 << 20, 200_000, 1 << 18
# Source and term pairs of a block; partitions that each transducer, and each group there, meets at least.
CELLS, SALTS, SPREAD = 1 << 16, 8, 4

# Letters and bytes of other code points than ASCII stay, A-Z lowered; all else parts terms.
_TERM = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, part by part."""
    plain, at = text.translate(_TERM), 0
    while at < len(plain):
        end = len(plain)
        if end - at > PART:
            end = plain.rfind(b" ", at, at + PART)
            if end <= at:
                end = plain.find(b" ", at + PART)
                end = len(plain) if end < 0 else end
        yield plain[at:end].split()
        at = max(end, at + 1)


def key_prefix(lang: str) -> bytes:
    """The language in a key, without zero bytes, and its end."""
    return lang.encode().replace(b"\1", b"\1\2").replace(b"\0", b"\1\1") + b"\0"


class Transducer:
    """A minimal acyclic automaton whose outputs add up to a key's ordinal."""

    def __init__(self, edges: np.ndarray, targets: np.ndarray, outputs: np.ndarray, final: np.ndarray):
        # Edges are named by state * 256 + byte and sorted; the last state is the first one.
        self.edges, self.targets, self.outputs, self.final = edges, targets, outputs, final

    @classmethod
    def build(cls, keys: Iterator[bytes]) -> Transducer:
        """From distinct keys in ascending order. States are made when the next key leaves them, and
        equal ones are one."""
        states: dict[tuple, int] = {}
        sizes: list[int] = []
        # The way of the last key: [final, edges so far], the edge to the next one still open.
        way: list[list] = [[False, []]]
        last = b""

        def close(depth: int) -> None:
            while len(way) > depth + 1:
                final, edges = way.pop()
                found = (final, tuple(edges))
                state = states.get(found)
                if state is None:
                    state = states[found] = len(sizes)
                    sizes.append(final + sum(sizes[target] for _, target in edges))
                way[-1][1].append((last[len(way) - 1], state))

        for key in keys:
            shared = 0
            for a, b in zip(last, key):
                if a != b:
                    break
                shared += 1
            close(shared)
            way.extend([False, []] for _ in range(len(key) - shared))
            way[-1][0] = True
            last = key
        close(0)
        states[way[0][0], tuple(way[0][1]), "root"] = len(sizes)
        rows = []
        for (final, edges, *_), state in states.items():
            before = int(final)
            for byte, target in edges:
                rows.append((state << 8 | byte, target, before))
                before += sizes[target]
        table = np.array(sorted(rows), np.int64).reshape(-1, 3)
        ends = np.zeros(len(states), np.uint8)
        for (final, *_), state in states.items():
            ends[state] = final
        return cls(*(np.ascontiguousarray(table[:, i]) for i in range(3)), ends)

    def dump(self) -> bytes:
        return b"".join([np.int64(len(self.edges)).tobytes(), self.edges.tobytes(), self.targets.tobytes(),
                         self.outputs.tobytes(), self.final.tobytes()])

    @classmethod
    def load(cls, data: bytes) -> Transducer:
        n = int(np.frombuffer(data, np.int64, 1)[0])
        parts = [np.frombuffer(data, np.int64, n, 8 + 8 * n * i) for i in range(3)]
        return cls(*parts, np.frombuffer(data, np.uint8, offset=8 + 24 * n))

    def _step(self, states: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The edge taken from each state, and whether there is one."""
        names = states << 8 | letters
        at = np.minimum(np.searchsorted(self.edges, names), len(self.edges) - 1)
        return at, self.edges[at] == names

    def ordinals(self, prefix: bytes, text: bytes) -> np.ndarray:
        """The ordinal of prefix + term for each term of a text of terms set apart by a space; -1 for
        those not accepted."""
        data = np.frombuffer(text, np.uint8)
        starts = np.concatenate(([0], np.flatnonzero(data == 32) + 1))
        ends = np.concatenate((starts[1:] - 1, [len(data)]))
        out = np.full(len(starts), -1, np.int64)
        state, ordinal = len(self.final) - 1, 0
        for letter in prefix:
            at, there = self._step(np.array([state]), np.array([letter]))
            if not there[0]:
                return out
            state, ordinal = int(self.targets[at[0]]), ordinal + int(self.outputs[at[0]])
        active = np.arange(len(starts))
        states, sums, at = np.full(len(starts), state), np.full(len(starts), ordinal), starts
        while active.size:
            over = at == ends[active]
            if over.any():
                good = over & (self.final[states] > 0)
                out[active[good]] = sums[good]
                active, states, sums, at = (x[~over] for x in (active, states, sums, at))
                if not active.size:
                    break
            edge, there = self._step(states, data[at].astype(np.int64))
            active, edge = active[there], edge[there]
            states, sums, at = self.targets[edge], sums[there] + self.outputs[edge], at[there] + 1
        return out


def _texts(batch: pa.RecordBatch, name: str) -> list[bytes]:
    return batch.column(name).cast(pa.binary()).to_pylist()


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, Counter] = defaultdict(Counter)

    def rows() -> pa.RecordBatch:
        langs = [lang for lang, found in held.items() for _ in range(len(found))]
        keys = [term for found in held.values() for term in found]
        n = [count for found in held.values() for count in found.values()]
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(keys, pa.binary()).cast(pa.string()),
                                           pa.array(n, pa.int64())], names=["lang", "term", "n"])

    for batch in batches:
        for text, lang in zip(_texts(batch, "text"), batch.column("lang").to_pylist()):
            once: set[bytes] = set()
            for part in terms_of(text):
                once.update(part)
            held[lang].update(once)
        if sum(map(len, held.values())) > HELD:
            yield rows()
    if held:
        yield rows()


def kept_terms(documents: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """(lang, term) of the terms in at least ``least`` documents of the language."""
    return (documents.select("text", "lang").mapInArrow(_document_counts, "lang string, term string, n long")
            .groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("lang", "term"))


def _built(most: int):
    """Of keys in order: each run's transducer (with its number of terms), and each term's place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[bytes] = []
        names: list[tuple[str, str]] = []
        size = 0

        def rows() -> pa.RecordBatch:
            n = len(keys)
            columns = ([keys[0]] * (n + 1), [n, *range(n)], [Transducer.build(iter(keys)).dump(), *[None] * n],
                       [None, *(lang for lang, _ in names)], [None, *(term for _, term in names)])
            kinds = (pa.binary(), pa.int64(), pa.binary(), pa.string(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                              names=["first", "n", "built", "lang", "term"])

        for batch in batches:
            for key, lang, term in zip(*(batch.column(i).to_pylist() for i in range(3))):
                keys.append(bytes(key))
                names.append((lang, term))
                size += len(key)
                if len(keys) == most or size >= SHARD_BYTES:
                    yield rows()
                    keys, names, size = [], [], 0
        if keys:
            yield rows()
    return run


def vocabulary(kept: DataFrame, most: int = SHARD_TERMS) -> tuple[DataFrame, DataFrame]:
    """The transducers of at most ``most`` terms (first key, n, built, base) and the terms (lang, term,
    ordinal), the ordinal counted through all languages."""
    plain = F.replace(F.replace("lang", F.lit("\1"), F.lit("\1\2")), F.lit("\0"), F.lit("\1\1"))
    key = F.concat(F.encode(plain, "utf-8"), F.lit(bytes([0])), F.encode("term", "utf-8"))
    ordered = (kept.select(key.alias("key"), "lang", "term").repartitionByRange("key").sortWithinPartitions("key"))
    built = common.stored(ordered.mapInArrow(
        _built(most), "first binary, n long, built binary, lang string, term string"), "vocabulary")
    runs = built.where("built IS NOT NULL").select("first", "n", "built")
    # One row per run, so this window is small.
    before = Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    bases = runs.select("first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    terms = built.where("built IS NULL").join(bases, "first").select(
        "lang", "term", (F.col("base") + F.col("n")).alias("ordinal"))
    return runs.join(bases, "first"), terms


def _messages(firsts: list[bytes], most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], Counter] = defaultdict(Counter)

        def rows() -> Iterator[pa.RecordBatch]:
            for (lang, source), found in held.items():
                prefix, sent = key_prefix(lang), []
                ordered = sorted(found)
                counts = np.array([found[t] for t in ordered], np.int64)
                ends = np.cumsum([len(t) + 1 for t in ordered])
                at = 0
                while at < len(ordered):
                    run = max(0, bisect_right(firsts, prefix + ordered[at]) - 1)
                    # A message ends where the next run of keys begins, or when it is long enough.
                    end = int(np.searchsorted(ends, ends[at] + most, "right"))
                    if run + 1 < len(firsts) and prefix + ordered[end - 1] >= firsts[run + 1]:
                        end = bisect_left(ordered, firsts[run + 1][len(prefix):], at, end)
                    sent.append((lang, source, run, b" ".join(ordered[at:end]), counts[at:end].tobytes()))
                    at = end
                kinds = (pa.string(), pa.string(), pa.int64(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*sent)) or [[]] * 5, kinds)],
                                                 names=["lang", "source", "run", "text", "counts"])
            held.clear()

        for batch in batches:
            for text, lang, source in zip(_texts(batch, "text"), batch.column("lang").to_pylist(),
                                          batch.column("source").to_pylist()):
                found = held[lang, source]
                for part in terms_of(text):
                    found.update(part)
            if sum(map(len, held.values())) > HELD:
                yield from rows()
        yield from rows()
    return run


def _recounted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts per group and ordinal; messages of one group follow each other and are added up."""
    run = base = built = group = None
    ordinals, counts = [], []

    def rows() -> Iterator[pa.RecordBatch]:
        if ordinals:
            found, at = np.unique(np.concatenate(ordinals), return_inverse=True)
            total = np.zeros(len(found), np.int64)
            np.add.at(total, at, np.concatenate(counts))
            yield pa.RecordBatch.from_arrays(
                [pa.array([group[0]] * len(found), pa.string()), pa.array([group[1]] * len(found), pa.string()),
                 pa.array(found + base), pa.array(total)], names=["lang", "source", "ordinal", "n"])
        ordinals.clear()
        counts.clear()

    for batch in batches:
        for row in batch.to_pylist():
            own = None if row["base"] is not None else (row["lang"], row["source"])
            if own != group or sum(map(len, ordinals)) > HELD:
                yield from rows()
                group = own
            if own is None:
                run, base, built = row["run"], row["base"], Transducer.load(row["text"])
                continue
            if row["run"] != run:
                raise RuntimeError(f"no transducer came before the messages of run {row['run']}")
            found = built.ordinals(key_prefix(row["lang"]), row["text"])
            ordinals.append(found[found >= 0])
            counts.append(np.frombuffer(row["counts"], np.int64)[found >= 0])
    yield from rows()


def recount(documents: DataFrame, runs: DataFrame, message: int = MESSAGE) -> DataFrame:
    """(lang, source, ordinal, n): how often each kept term occurs in each group; only where it does."""
    spark = documents.sparkSession
    # One key per run of up to SHARD_TERMS terms reaches the driver.
    firsts = [bytes(r["first"]) for r in runs.select("first").orderBy("first").collect()]
    if not firsts:
        return spark.createDataFrame([], "lang string, source string, ordinal long, n long")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salts = max(SALTS, -(-4 * partitions // len(firsts)))
    # A group's messages go to a part of the salts, where they add up; a large group is still dealt.
    spread = max(SPREAD, salts // 16)
    texts = documents.select("text", "lang", "source").mapInArrow(
        _messages(firsts, message), "lang string, source string, run long, text binary, counts binary")
    sent = texts.withColumn("salt", F.pmod(F.xxhash64("lang", "source") % salts + F.pmod(F.xxhash64("text", "counts"), F.lit(spread)),
                                           F.lit(salts)))
    number = F.row_number().over(Window.orderBy("first")) - 1
    numbered = runs.select("first", "base", number.cast("long").alias("run")).join(runs.select("first", "built"), "first")
    every = numbered.select("run", "base", F.col("built").alias("text")).withColumn(
        "salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    streamed = (sent.unionByName(every, allowMissingColumns=True).repartition("run", "salt")
                .sortWithinPartitions("run", "salt", F.col("base").asc_nulls_last(), "lang", "source"))
    return (streamed.select("lang", "source", "run", "text", "counts", "base")
            .mapInArrow(_recounted, "lang string, source string, ordinal long, n long")
            .groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n")))


def _billionths(x: str, m: str) -> str:
    """1 + floor(10^9 x / m) as long division by three digits at a time, so nothing overflows."""
    one, two = f"({x}) * 1000 % ({m})", f"(({x}) * 1000 % ({m})) * 1000 % ({m})"
    return (f"1 + (({x}) * 1000 div ({m})) * 1000000 + (({one}) * 1000 div ({m})) * 1000 + (({two}) * 1000 div ({m}))")


def billionths(x: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The same of arrays."""
    out = np.zeros(np.broadcast(x, m).shape, np.int64)
    for _ in range(3):
        whole, x = np.divmod(x * 1000, m)
        out = out * 1000 + whole
    return 1 + out


def group_totals(documents: DataFrame, counts: DataFrame, terms: DataFrame) -> DataFrame:
    """(lang, source, total, lang_total, v, base, width, blocks) of every occurring group."""
    groups = documents.select("lang", "source").distinct()
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = terms.groupBy("lang").agg(F.count("*").alias("v"), F.min("ordinal").alias("base"))
    known = (groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
             .fillna(0, ["total", "v", "base"]))
    of_lang = known.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.count("*").alias("sources"))
    return (known.join(of_lang, "lang")
            .withColumn("width", F.expr(f"greatest(1, {CELLS} div sources)"))
            .withColumn("blocks", F.expr("greatest(1, (v + width - 1) div width)")))


PLACES = "lang string, source string, block long, place long, n long, total long, v long, width long"


def _pairs(key: tuple, table: pa.Table) -> pa.Table:
    """Divergences of all pairs of sources over one block of terms."""
    lang, block = (k.as_py() for k in key)
    column = {name: table[name].to_pylist() for name in ("source", "place", "n", "total", "v", "width")}
    own = {s: (t, v, w) for s, p, t, v, w in zip(*(column[c] for c in ("source", "place", "total", "v", "width"))) if p is None}
    sources = sorted(own)
    v, width = next(iter(own.values()))[1:]
    size = min(width, v - block * width) if v else 0
    counts = np.zeros((len(sources), size), np.int64)
    row = {s: i for i, s in enumerate(sources)}
    for s, p, n in zip(column["source"], column["place"], column["n"]):
        if p is not None:
            counts[row[s], p] = n
    totals = np.array([own[s][0] for s in sources], np.int64)
    p = billionths(counts + 2, (totals + 2 * v)[:, None]) if v else counts
    names, others, values = [], [], []
    for i, source in enumerate(sources[:-1]):
        rest = p[i + 1:]
        values += ((rest - p[i]) ** 2 // (rest + p[i])).sum(axis=1).tolist()
        others += sources[i + 1:]
        names += [source] * (len(sources) - i - 1)
    return pa.table({"lang": pa.array([lang] * len(names), pa.string()), "a": pa.array(names, pa.string()),
                     "b": pa.array(others, pa.string()), "value": pa.array(values, pa.int64())})


def pairs(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, source, item, value) of each group and each other source of its language."""
    cells = (join_per_key(counts, totals.select("lang", "source", "base", "width"), ["lang", "source"])
             .withColumn("_at", F.col("ordinal") - F.col("base"))
             .selectExpr("lang", "source", "_at div width AS block", "_at % width AS place", "n"))
    every = totals.select("lang", "source", "total", "v", "width",
                          F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    found = (cells.unionByName(every, allowMissingColumns=True).groupBy("lang", "block")
             .applyInArrow(_pairs, "lang string, a string, b string, value long")
             .groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
    both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                             F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    return found.select("lang", both.alias("x"), "value").select("lang", "x.source", "x.item", "value")


def telling_terms(counts: DataFrame, totals: DataFrame, terms: DataFrame, top: int = TOP) -> DataFrame:
    """(lang, source, item, value, rank): the terms a group uses most above its language."""
    whole = counts.groupBy("ordinal").agg(F.sum("n").alias("lang_n"))
    p, q = _billionths("n + 2", "total + 2 * v"), _billionths("lang_n + 2", "lang_total + 2 * v")
    scored = (join_per_key(counts.join(whole, "ordinal"), totals.select("lang", "source", "total", "lang_total", "v"),
                           ["lang", "source"])
              .selectExpr("lang", "source", "ordinal", f"{p} AS p", f"{q} AS q").where("p > q")
              .selectExpr("lang", "source", "ordinal", "(p - q) * (p - q) div (p + q) AS value"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    ranked = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(terms.select("ordinal", F.col("term").alias("item")), "ordinal").select(
        "lang", "source", "item", "value", "rank")


def audit(documents: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank) of all groups: part ``pair`` against each other source,
    part ``term`` the most telling terms."""
    rows = documents.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("text", "lang", "source")))
    runs, terms = vocabulary(kept_terms(rows, least))
    terms = common.stored(terms, "terms")
    counts = common.stored(recount(rows, runs), "counts")
    totals = common.stored(group_totals(rows, counts, terms), "totals")
    in_order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    both = pairs(counts, totals).withColumn("rank", F.row_number().over(in_order))
    columns = ("lang", "source", "part", "item", "value", "rank")
    return both.withColumn("part", F.lit("pair")).select(*columns).unionByName(
        telling_terms(counts, totals, terms, top).withColumn("part", F.lit("term")).select(*columns))
