"""Quotation linking: reply structure from quoted passages; built-in expressions only.

A line's quote level is the number of ``>`` it begins with. Runs of lines of one level are passages.
Passages are normalised (lower case, runs of anything but letters and digits become one space) and
hashed. Within a conversation a quoted passage belongs to the earliest message, before the quoting
one, whose own words hold it as a whole, as a paragraph or as a line; where no message holds the
whole passage, its longest line decides. The shallowest linked quote, the latest message among
equals, names the message replied to. Roots and depths follow by pointer doubling, so a chain of n
replies takes log n rounds.

The earliest message with a passage is one minimum per conversation and hash, combined before the
shuffle, so a line that a third of all messages share is one row, and adaptive execution splits the
quotes of a hot line. No group is collected and no pairs are made.

``messages`` gives one row per distinct message row: conversation, position, role, body (without
quotes), parent, root, depth, n_quotes, n_linked, and ``reply_order`` (root, depth, position), by
which a conversation's rows are in reply order.

Defined results: a null text is empty; a very long text, or one of very many lines or quote marks,
takes time in proportion to its length, in one task; repeated rows count once; several texts under one position
are one message with several rows; a null conversation or position is never linked, and its row
comes back with no parent, itself as root (null position) and depth 0. Columns of other names pass
unread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillwise import scratch

NODE = ["conversation", "position"]
MOST_ROUNDS = 64


def _normal(x: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(x), r"[^\p{L}\p{N}]+", " "))


def parse(messages: DataFrame, conversation: str, position: str, role: str, text: str) -> DataFrame:
    """Distinct message rows with their passages (level, lines, normalised lines), in order.

    Lines, levels and starts are columns of their own, each referred to more than once above, so
    they are made once per text and not once per line."""
    rows = messages.select(
        F.col(conversation).alias("conversation"), F.col(position).cast("long").alias("position"),
        F.col(role).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    ).distinct()
    # Possessive, so that a line of many marks is read in a loop.
    mark = r"^(?:>[ \t]?)++"
    rows = rows.withColumn("lines", F.split("text", "\r?\n", -1))
    rows = rows.withColumns({
        "levels": F.transform("lines", lambda x: F.length(F.regexp_replace(
            F.regexp_extract(x, mark, 0), r"[^>]", ""))),
        "said": F.transform("lines", lambda x: F.regexp_replace(x, mark, ""))})
    rows = rows.withColumn("plain", F.transform("said", _normal)).withColumn("starts", F.filter(
        F.sequence(F.lit(1), F.size("levels")),
        lambda i: (i == 1) | (F.element_at("levels", i) != F.element_at(F.col("levels"), F.greatest(i - 1, F.lit(1))))))
    following = F.concat(F.slice("starts", F.lit(2), F.size("starts")), F.array(F.size("levels") + 1))
    rows = rows.withColumn("ends", following)
    return rows.withColumn("passages", F.transform(
        F.arrays_zip("starts", "ends"), lambda x: F.struct(
            F.element_at("levels", x["starts"]).alias("level"),
            F.slice("said", x["starts"], x["ends"] - x["starts"]).alias("said"),
            F.slice("plain", x["starts"], x["ends"] - x["starts"]).alias("plain"))
    )).select("conversation", "position", "role", "passages")


def _whole(plain: Column) -> Column:
    """Lines joined and normalised: line breaks are nothing but letters and digits either."""
    return F.array_join(F.filter(plain, lambda s: s != ""), " ")


def _hash(plain: Column) -> Column:
    return F.when(plain != "", F.xxhash64(plain))


def keyed(parsed: DataFrame) -> DataFrame:
    """Message rows with their body (own words), ``units``: hashes of what a quote may hold of it
    (the body, its passages, paragraphs and lines), and ``quotes``: n, level and the hashes of the
    whole passage and of its longest line (null without a letter or digit)."""
    own = F.filter("passages", lambda p: p["level"] == 0)
    said = F.array_join(F.transform(own, lambda p: F.array_join(p["said"], "\n")), "\n")
    rows = parsed.withColumns({
        "body": F.btrim(said, F.lit(" \t\n\x0b\f\r")), "own": F.transform(own, lambda p: p["plain"])})
    units = F.concat(
        F.array(_whole(F.flatten("own"))), F.transform("own", _whole), F.flatten("own"),
        F.transform(F.split("body", r"\n\s*\n", -1), _normal))
    longest = lambda p: F.array_max(F.transform(p["plain"], lambda s: F.struct(F.length(s).alias("size"), s.alias("u"))))["u"]
    quotes = F.filter(F.transform("passages", lambda p, n: F.struct(
        n.alias("n"), p["level"].alias("level"), F.when(p["level"] > 0, _hash(_whole(p["plain"]))).alias("whole"),
        F.when(p["level"] > 0, _hash(longest(p))).alias("line"))), lambda q: q["level"] > 0)
    return rows.select(*NODE, "role", "body", quotes.alias("quotes"), F.array_distinct(F.transform(
        F.filter(units, lambda u: u != ""), lambda u: F.xxhash64(u))).alias("units"))


def links(messages: DataFrame) -> DataFrame:
    """(conversation, position, n, level, source) of ``keyed`` messages: the n-th quoted passage of
    a message and the position of the message it is from, null if none is found."""
    known = messages.dropna(subset=NODE)
    originals = (known.select(*NODE, F.explode("units").alias("hash"))
                 .groupBy("conversation", "hash").agg(F.min("position").alias("source")))
    wanted = known.select(*NODE, F.explode("quotes").alias("q")).select(*NODE, "q.n", "q.level", F.explode(F.array(
        F.struct(F.lit(0).alias("kind"), F.col("q.whole").alias("hash")),
        F.struct(F.lit(1).alias("kind"), F.col("q.line").alias("hash")))).alias("key")
    ).select(*NODE, "n", "level", "key.kind", "key.hash")
    # From a written table, so both sides of the join are plain shuffles and a hot key is split.
    originals = scratch.stored(messages.sparkSession, originals, "originals")
    found = wanted.join(originals, ["conversation", "hash"], "left")
    earlier = F.when(F.col("source") < F.col("position"), F.col("source"))
    return (found.groupBy(*NODE, "n", "level")
            .agg(F.min(F.when(earlier.isNotNull(), F.struct("kind", earlier.alias("source")))).alias("x"))
            .select(*NODE, "n", "level", "x.source"))


def replies(messages: DataFrame) -> DataFrame:
    """(conversation, position, parent, root, depth, n_quotes, n_linked) of every ``keyed`` message."""
    spark = messages.sparkSession
    best = F.max(F.when(F.col("source").isNotNull(), F.struct((-F.col("level")).alias("near"), "source")))
    linked = links(messages).groupBy(*NODE).agg(
        best["source"].alias("parent"), F.count("*").alias("n_quotes"), F.count("source").alias("n_linked"))
    nodes = scratch.stored(spark, messages.select(*NODE).dropna().distinct().join(linked, NODE, "left").select(
        *NODE, "parent", F.coalesce("n_quotes", F.lit(0)).alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0)).alias("n_linked")), "replies")
    # ``up`` is an ancestor ``steps`` above; once it is a root the message is done and joins no more.
    is_root = F.col("parent").isNull()
    ups = nodes.select(*NODE, F.coalesce("parent", "position").alias("up"),
                       F.when(is_root, 0).otherwise(1).cast("long").alias("steps"), is_root.alias("done"))
    done, open_ = ups.where("done"), ups.where("NOT done")
    for _ in range(MOST_ROUNDS):
        far = done.unionByName(open_).select("conversation", F.col("position").alias("up"), F.col("up").alias("_up"),
                                             F.col("steps").alias("_steps"), F.col("done").alias("_done"))
        after = scratch.stored(spark, open_.drop("done").join(far, ["conversation", "up"]).select(
            *NODE, F.col("_up").alias("up"), (F.col("steps") + F.col("_steps")).alias("steps"),
            F.col("_done").alias("done")), "steps")
        done, open_ = done.unionByName(after.where("done")), after.where("NOT done")
        if open_.isEmpty():
            break
    else:
        raise RuntimeError(f"messages without a root after {MOST_ROUNDS} rounds")
    return nodes.join(done.select(*NODE, F.col("up").alias("root"), F.col("steps").alias("depth")), NODE)


def messages(rows: DataFrame, conversation: str, position: str, role: str, text: str) -> DataFrame:
    """Messages without quotes, with their place in the reply order."""
    own = scratch.stored(rows.sparkSession, keyed(parse(rows, conversation, position, role, text)), "messages")
    joined = own.select(*NODE, "role", "body").join(replies(own), NODE, "left")
    root = F.coalesce("root", "position")
    depth = F.coalesce("depth", F.lit(0).cast("long"))
    return joined.select(
        *NODE, "role", "body", "parent", root.alias("root"), depth.alias("depth"),
        F.coalesce("n_quotes", F.lit(0).cast("long")).alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0).cast("long")).alias("n_linked"),
        F.array(root, depth, F.col("position")).alias("reply_order"))


def mailbox(conversations: DataFrame) -> DataFrame:
    """Conversation turns as mail: each turn's text over a quote of the turn before, and below that,
    one level deeper, of the turn before that. The table itself holds no quotes."""
    turns = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))

    def before(n: int) -> DataFrame:
        return (conversations.where("conv_id IS NOT NULL AND turn IS NOT NULL")
                .groupBy("conv_id", (F.col("turn") + n).alias("turn")).agg(F.min("text").alias(f"t{n}")))

    def quote(x: Column, mark: str) -> Column:
        return F.concat(F.lit("\n" + mark), F.regexp_replace(x, "\n", "\n" + mark))

    both = turns.join(before(1), ["conv_id", "turn"], "left").join(before(2), ["conv_id", "turn"], "left")
    return both.select("conv_id", "turn", "role", F.concat(
        "text", F.coalesce(F.concat(F.lit("\n"), quote(F.col("t1"), "> ")), F.lit("")),
        F.coalesce(quote(F.col("t2"), ">> "), F.lit(""))).alias("text"))
