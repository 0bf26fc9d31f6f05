r"""Chat formatting by quotation linking (DataFrame functions only).

Messages may quote others, mail style: a line's level is its number of
leading ``>``. Consecutive lines of one level form a passage; a passage is
normalised (lower case, white space collapsed, quote marks and edges trimmed)
and hashed, and so is every unquoted passage and every unquoted line of every
message. A quoted passage is joined to the earliest earlier message of the same
conversation that wrote it itself. A quoted passage without such an original is
cut into its lines and sentences, which are joined to the lines and sentences
of earlier messages; the longest one found gives the passage's original. The
first linked passage of the lowest level makes that message the reply's parent. Following the parents gives each
message its thread; a conversation is put into reply order by thread (the
turn of its root), then turn, and the quotes are taken out of the texts. The rows
come range-partitioned and sorted by conversation, thread and turn.

Originals are reduced to one row per (conversation, hash) with partial
aggregation before the join, so a hot passage or conversation never meets
itself; ranges are cut inside conversations, none is gathered in a task.

Defined results: null text is an empty message; a message whose quotes match
nothing, or without quotes, roots its own thread; rows with a null conv_id
form one conversation, a null turn comes first; repeated (conv_id, turn) rows
stay separate and share a thread; an empty table gives an empty result; only
the four named columns are read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirescope.llm import common as C

MIN_CHARS = 1  # shorter normalised passages link nothing
_SENTENCE = r"(?<=[.!?…])\s+|\n[ \t]*\n"
_MARK = r"^[ \t]*(?:>[ \t]*)+"


def lines(text: Column) -> Column:
    """The lines as structs (level, body)."""
    return F.transform(F.split(F.coalesce(text, F.lit("")), "\r\n|\n|\r"), lambda x: F.struct(
        F.length(F.regexp_replace(F.regexp_extract(x, _MARK, 0), "[^>]", "")).alias("level"),
        F.regexp_replace(x, _MARK, "").alias("body")))


def normalised(s: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(s), r"[\s \"'`‘’“”«»]+", " "))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once a row, also where ``use`` names it inside a lambda."""
    return F.transform(F.array(value), use)[0]


def passages(ls: Column) -> Column:
    """Runs of lines of one level, as structs (level, body), in order; a blank line is a run of its own.

    Linear in the lines: each line is marked as a run's first or not, the lines are joined to one string
    in which a carriage return (which no line holds) parts levels and bodies, and that is split.
    """
    def marked(xs: Column) -> Column:
        def one(i: Column) -> Column:
            x, last = xs[i], xs[i - 1]
            # looked at only behind the first line
            starts = (x["level"] != last["level"]) | (F.trim(x["body"]) == "") | (F.trim(last["body"]) == "")
            head = F.concat(F.lit("\r"), x["level"].cast("string"), F.lit("\r"))
            return F.concat(F.when(i == 0, head).when(starts, head).otherwise(F.lit("\n")), x["body"])

        return F.array_join(F.transform(F.sequence(F.lit(0), F.size(xs) - 1), one), "")

    return _let(F.split(_let(ls, marked), "\r"), lambda ps: F.transform(
        F.sequence(F.lit(1), F.size(ps) - 1, F.lit(2)),
        lambda k: F.struct(ps[k].cast("int").alias("level"), ps[k + 1].alias("body"))))


def fingerprint(s: Column) -> Column:
    """128 bits of the normalised passage; null if too short."""
    n = normalised(s)
    return F.when(F.length(n) >= MIN_CHARS, F.md5(n))


def pieces(s: Column) -> Column:
    """The lines, the sentences, and the sentences of each line."""
    ls = F.split(s, "\n")
    return F.array_distinct(F.concat(ls, F.split(s, _SENTENCE), F.flatten(F.transform(ls, lambda x: F.split(x, _SENTENCE)))))


def originals(asking: DataFrame, parsed: DataFrame, parts: Column) -> DataFrame:
    """``asking`` (conv_id, turn, h, ...) with the earlier ``origin`` whose message first wrote one of ``parts`` so."""
    # only hashes that some quote of that conversation asks for are kept
    asked = asking.groupBy("conv_id", "h").agg(F.count("*").alias("n"))
    # only conversations that ask are taken apart
    who = C.small_side(C.stored(asking.select(F.col("conv_id").alias("who")).distinct(), "chat-asking"))
    parsed = parsed.join(who, F.col("conv_id").eqNullSafe(F.col("who")), "left_semi")
    written = (parsed.select("conv_id", "turn", F.explode(parts).alias("part"))
               .select("conv_id", "turn", fingerprint(F.col("part")).alias("h")).filter("h is not null")
               .groupBy("conv_id", "h").agg(F.min("turn").alias("origin"))
               .select(F.col("conv_id").alias("c"), F.col("h").alias("oh"), "origin"))
    links = (asked.join(written, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("h") == F.col("oh")))
             .select(F.col("c"), F.col("oh"), "origin"))
    return asking.join(links, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("h") == F.col("oh"))
                       & (F.col("origin") < F.col("turn"))).select(*asking.columns, "origin")


def link_quotes(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str = "text") -> DataFrame:
    """One row per message, in reply order: conv_id, turn, role, thread, reply_to, n_quotes, n_linked, text, formatted."""
    src = messages.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"),
                          F.coalesce(F.col(text), F.lit("")).alias("raw"))
    quoted = F.col("raw").rlike(r"(?:^|[\r\n])[ \t]*>")
    ls = lines(F.col("raw"))
    own = F.concat_ws("\n", F.transform(F.filter(ls, lambda x: x["level"] == 0), lambda x: x["body"]))
    parsed = src.select(
        "conv_id", "turn", "role", quoted.alias("quoted"), "raw",
        F.when(quoted, F.regexp_replace(F.regexp_replace(own, r"\n{3,}", "\n\n"), r"^\s+|\s+$", "")).otherwise(F.col("raw")).alias("text"))

    # quotes: (conv_id, turn, place, level, h, body); only messages that quote are taken apart
    quotes = C.stored(
        parsed.filter("quoted").select(
            "conv_id", "turn", F.posexplode(F.filter(passages(lines(F.col("raw"))), lambda p: p["level"] > 0))
            .alias("place", "p"))
        .select("conv_id", "turn", "place", "p.level", fingerprint(F.col("p.body")).alias("h"), "p.body")
        .filter("h is not null").dropDuplicates(["conv_id", "turn", "place", "level", "h"]), "chat-quotes")
    # originals: whole messages, their paragraphs and lines, at the earliest turn that wrote them
    parts = F.array_distinct(F.concat(
        F.array(F.col("text")), F.split("text", r"\n[ \t]*\n"), F.split("text", "\n")))
    names = ["conv_id", "turn", "place", "level", "h"]
    found = C.stored(originals(quotes.select(*names), parsed, parts), "chat-found")
    hit = found.select(*[F.col(c).alias(f"f_{c}") for c in names])
    missed = C.stored(quotes.join(hit, F.expr(" and ".join(f"{c} <=> f_{c}" for c in names)), "left_anti"), "chat-missed")
    if missed.limit(1).count():
        cut = (missed.select("conv_id", "turn", "place", "level", F.col("h").alias("whole"),
                             F.posexplode(pieces(F.col("body"))).alias("part", "piece"))
               .select("conv_id", "turn", "place", "level", "whole", "part",
                       F.length(normalised(F.col("piece"))).alias("size"), fingerprint(F.col("piece")).alias("h"))
               .filter("h is not null"))
        found = found.unionByName(
            originals(cut, parsed, pieces(F.col("text"))).groupBy("conv_id", "turn", "place", "level", F.col("whole").alias("h"))
            .agg(F.min(F.struct(-F.col("size"), "part", "origin"))["origin"].alias("origin")))
    parent = C.stored(found.groupBy("conv_id", "turn").agg(
        F.min(F.struct("level", "place", "origin"))["origin"].alias("reply_to"),
        F.count("*").alias("n_linked")), "chat-links")
    roots = thread_roots(parent).select(F.col("conv_id").alias("rc"), F.col("turn").alias("rt"),
                                        "reply_to", "n_linked", "root")
    counted = F.size(F.filter(passages(ls), lambda p: p["level"] > 0))
    out = parsed.join(roots, F.col("conv_id").eqNullSafe(F.col("rc")) & F.col("turn").eqNullSafe(F.col("rt")), "left")
    return out.select(
        "conv_id", "turn", "role", F.coalesce("root", "turn").alias("thread"), "reply_to",
        F.when(F.col("quoted"), counted).otherwise(0).cast("long").alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"), "text",
        F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), F.col("text"), F.lit("\n"))
        .alias("formatted")).orderBy("conv_id", "thread", "turn")


def thread_roots(parent: DataFrame) -> DataFrame:
    """Follow ``reply_to`` to the first message of the thread, by pointer doubling.

    Parents are earlier turns, so the pointers end; every round halves what is
    left of the longest chain. Only messages with a linked quote take part.
    """
    at = C.stored(parent.withColumn("root", F.col("reply_to")), "chat-roots")
    while True:
        nxt = at.select(F.col("conv_id").alias("nc"), F.col("turn").alias("nt"), F.col("root").alias("nr"))
        moved = C.stored(
            at.join(nxt, F.col("conv_id").eqNullSafe(F.col("nc")) & (F.col("root") == F.col("nt")), "left")
            .select(*at.columns[:-1], F.coalesce("nr", "root").alias("root"), F.col("nr").isNotNull().alias("m")),
            "chat-roots")
        more = moved.filter("m").limit(1).count()
        at = moved.drop("m")
        if not more:
            return at


def op5_quote_linking(spark: SparkSession, base: str) -> DataFrame:
    """All conversations in reply order, without quotes."""
    return link_quotes(C.read(spark, base, "conversations"))
