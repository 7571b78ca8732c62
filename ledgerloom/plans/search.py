"""Keyword search over mailboxes: terms, mailboxes, ranked unique messages, digest."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import reference_data as ref
from ..functions.dates import day
from ..functions.text import haystack
from ..operators.ordered import one_per_key, ranked_union, top_n_per_key
from ..params import SearchPreset
from ..shared import settled
from ..sources.sizes import ROW_BYTES, broadcast_limit

UNKNOWN_SENDER = "Desconocido"
#: White space between words; characters of a gram.
GAP, GRAM = r"[\x20\x09-\x0D]+", 3


def _rows(spark: SparkSession, names: Sequence[str], rows: Sequence[tuple]) -> DataFrame:
    """A small fixed table."""
    items = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*items)))


def search_terms(queries: DataFrame, limit: int, *, translations=ref.TRANSLATIONS, rules=ref.TERM_RULES,
                 stop_words=ref.STOP_WORDS) -> DataFrame:
    """Search terms of each query, in order, at most ``limit``: its words, their translation, rule terms.

    A word counts as often as it is written; a translation or rule term is added only if no
    earlier term equals it.
    """
    spark = queries.sparkSession
    lowered = queries.select("query_id", F.lower("query").alias("query"))
    words = lowered.select("query_id", F.posexplode(F.split("query", r"(?U)\s+")).alias("pos", "word")).filter(
        (F.length("word") > 2) & ~F.col("word").isin(*stop_words))
    found = _rows(spark, ("word", "term"), list(translations.items()))
    translated = words.join(F.broadcast(found), "word").select("query_id", F.struct(F.col("pos"), F.lit(1).alias("step")).alias("place"), "term")
    typed = words.select("query_id", F.struct(F.col("pos"), F.lit(0).alias("step")).alias("place"), F.col("word").alias("term"))
    ruled = None
    for i, (triggers, extra) in enumerate(rules):
        hit = F.lit(False)
        for trigger in triggers:
            hit = hit | F.contains("query", F.lit(trigger))
        added = F.array(*[F.struct(F.struct(F.lit(2**30 + i).alias("pos"), F.lit(j).alias("step")).alias("place"),
                                   F.lit(term).alias("term")) for j, term in enumerate(extra)])
        rows = lowered.filter(hit).select("query_id", F.inline(added))
        ruled = rows if ruled is None else ruled.unionByName(rows)
    # Typed words repeat; added terms yield to any equal term before them.
    added = translated if ruled is None else translated.unionByName(ruled)
    first_typed = typed.groupBy("query_id", "term").agg(F.min("place").alias("_typed"))
    added = one_per_key(added, ["query_id", "term"], [F.col("place")])
    added = added.join(first_typed, ["query_id", "term"], "left").filter(
        F.col("_typed").isNull() | (F.col("place") < F.col("_typed"))).drop("_typed")
    ranked = top_n_per_key(typed.unionByName(added), ["query_id"], [F.col("place")], limit, "term_rank")
    return ranked.select("query_id", "term_rank", "term")


def mailboxes(messages: DataFrame, priority: Sequence[str], limit: int) -> DataFrame:
    """Mailboxes to search: the priority list, then real mailboxes in name order, at most ``limit``."""
    spark = messages.sparkSession
    first = _rows(spark, ("mailbox", "place"), [(m, i) for i, m in enumerate(priority)])
    name = F.lower("mailbox")
    real = F.contains("mailbox", F.lit("@"))
    for mark in ref.SERVICE_MAILBOX_MARKS:
        real = real & ~F.contains(name, F.lit(mark))
    chosen = ranked_union(first, messages.filter(real).select("mailbox"), "mailbox", "place", limit)
    rank = F.when(F.col("mailbox").isin(*priority), F.array_position(F.array(*[F.lit(m) for m in priority]), F.col("mailbox")))
    return chosen.select("mailbox", rank.cast("int").alias("priority"))


def mailbox_order() -> list[Column]:
    return [F.asc_nulls_last("priority"), F.col("mailbox")]


def _grams(c: Column, size: int) -> Column:
    """All runs of ``size`` characters of a text."""
    return F.regexp_extract_all(c, F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1))


def word_index(rows: DataFrame, text: Column, key: str = "id") -> DataFrame:
    """The inverted index of words: one row (``key``, ``word``) per text and distinct word.

    A word is what white space separates; texts are indexed whole. ``key`` is unique in ``rows``. The rows stay where their
    text is read: they are many times the texts, and of most words only the vocabulary needs to know.
    """
    return rows.select(key, F.explode(F.array_distinct(F.split(text, GAP))).alias("word")).filter("word <> ''")


def indexed_hits(words: DataFrame, matches: DataFrame, key: str = "id") -> DataFrame:
    """(``key``, term, whole): the texts that hold a matching word; ``matches`` is settled ``word_hits``.

    The matching words are those of the terms, far fewer than the index. Where their measured size fits the broadcast limit
    they go to the index rows, which are not shuffled; else both meet by the word.
    """
    held = matches.agg(F.sum(F.octet_length("word") + F.octet_length("term") + ROW_BYTES)).first()[0] or 0
    matches = F.broadcast(matches) if held <= broadcast_limit(words) else matches
    return words.join(matches, "word").select(key, "term", "whole").distinct()


def gram_index(words: DataFrame, sizes: Sequence[int] = (GRAM,)) -> DataFrame:
    """The inverted index of character grams over the vocabulary: one row (``gram``, ``word``) per distinct word and gram.

    The vocabulary grows far slower than the texts, so grams are made of distinct words and never of texts.
    """
    grams = F.concat(*[_grams(F.col("word"), n) for n in sizes])
    return words.select("word").distinct().select(F.explode(F.array_distinct(grams)).alias("gram"), "word")


def term_pieces(terms: DataFrame) -> DataFrame:
    """(term, piece): the longest word of each distinct term. A term of white space alone has none."""
    pieces = F.filter(F.split("term", GAP), lambda w: w != "")
    longest = F.array_max(F.transform(pieces, lambda w: F.struct(F.length(w).alias("n"), w.alias("piece"))))["piece"]
    return terms.select("term").distinct().select("term", longest.alias("piece")).filter("piece IS NOT NULL")


def word_hits(grams: DataFrame, pieces: DataFrame) -> DataFrame:
    """(term, whole, word): the words that contain the piece of a term; ``whole`` tells that the piece is all of it.

    Each term goes by the rarest gram of its piece: it meets the words that have this gram, and those are compared.
    """
    own = F.when(F.length("piece") < GRAM, F.array("piece")).otherwise(_grams(F.col("piece"), GRAM))
    asked = pieces.select("term", "piece", F.explode(F.array_distinct(own)).alias("gram"))
    # The same frame, word and all, goes into both joins on the gram, so that Spark makes and shuffles it once.
    counts = grams.join(asked.select("gram").distinct(), "gram").groupBy("gram").agg(F.count("word").alias("_words"))
    rarest = asked.join(counts, "gram").groupBy("term", "piece").agg(F.min(F.struct("_words", "gram"))["gram"].alias("gram"))
    found = grams.join(rarest, "gram").filter(F.contains("word", "piece"))
    return found.select("term", (F.col("piece") == F.col("term")).alias("whole"), "word")


def term_hits(rows: DataFrame, text: Column, terms: DataFrame, key: str = "id") -> DataFrame:
    """One row (``key``, ``term``) per row of ``rows`` and distinct term that its text contains.

    A term without white space lies in a text just where it lies in one of its words, so the indexes answer it. Of a term of
    several words the longest finds the candidates, and their texts are compared. A term of white space alone finds nothing.
    """
    words, pieces = word_index(rows, text, key), term_pieces(terms)
    # Pieces shorter than a gram need grams of their own length; most searches have none, and no terms of several words.
    kinds = pieces.select(F.length("piece").alias("n"), (F.col("term") == F.col("piece")).alias("whole")).distinct().collect()
    sizes = (GRAM, *sorted({r["n"] for r in kinds if r["n"] < GRAM}))
    hits = indexed_hits(words, settled(word_hits(gram_index(words, sizes), pieces)), key)
    if all(r["whole"] for r in kinds):
        return hits.select(key, "term")
    compared = hits.filter("NOT whole").join(rows.select(key, text.alias("_text")), key).filter(F.contains("_text", "term"))
    return hits.filter("whole").select(key, "term").unionByName(compared.select(key, "term"))


def find_messages(messages: DataFrame, terms: DataFrame, boxes: DataFrame, preset: SearchPreset,
                  as_of: dt.date) -> DataFrame:
    """Newest messages per (query, mailbox, term) that contain the term, each message once per query.

    The newest ones per mailbox and term are chosen before the queries of a term come in, so a term that many queries share
    costs what it costs once. Hits carry no texts; senders and subjects join the chosen messages.
    """
    if preset.has_date_floor:
        messages = messages.filter(F.col("received") >= day(as_of - dt.timedelta(days=preset.days_back)))
    kept = messages.join(F.broadcast(boxes.select("mailbox", "priority")), "mailbox")  # as many as the preset allows
    terms = settled(terms)
    hits = term_hits(kept.select("id", "subject", "body"), haystack("subject", "body"), terms)
    placed = hits.join(kept.select("id", F.col("mailbox").alias("searched_mailbox"), "priority", "received"), "id")
    newest = top_n_per_key(placed, ["searched_mailbox", "term"], [F.desc("received"), F.col("id")], preset.per_term, "_n").drop("_n")
    asked = newest.join(terms.select("query_id", "term_rank", "term"), "term").withColumnRenamed("term", "matched_term")
    seen_first = [F.asc_nulls_last("priority"), F.col("searched_mailbox"), F.col("term_rank")]
    found = one_per_key(asked, ["query_id", "id"], seen_first)
    return found.join(kept.select("id", "sender", "subject"), "id").select(
        "query_id", "matched_term", "id", "searched_mailbox", "sender", "subject", "received")


def message_order() -> list[Column]:
    return [F.desc("received"), F.col("id")]


def message_search(found: DataFrame, limit: int = 50) -> DataFrame:
    """The newest messages per query, at most ``limit``."""
    return top_n_per_key(found, ["query_id"], message_order(), limit, "rank")


def search_digest(found: DataFrame, senders: int = 5) -> DataFrame:
    """Per query: number of messages, the latest one, the senders with most messages."""
    counts = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("messages"))
    latest = one_per_key(found, ["query_id"], message_order()).select(
        "query_id", F.col("received").alias("latest_date"),
        F.coalesce("sender", F.lit(UNKNOWN_SENDER)).alias("latest_sender"), F.col("subject").alias("latest_subject"))
    per_sender = found.groupBy("query_id", F.coalesce("sender", F.lit(UNKNOWN_SENDER)).alias("sender")).agg(
        F.count(F.lit(1)).alias("n"))
    top = top_n_per_key(per_sender, ["query_id"], [F.desc("n"), F.col("sender")], senders)
    line = F.concat("sender", F.lit(": "), F.col("n").cast("string"))
    lines = top.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", line.alias("line")))).alias("_l"))
    joined = F.array_join(F.transform("_l", lambda r: r["line"]), "; ")
    return counts.join(latest, "query_id").join(lines.select("query_id", joined.alias("top_senders")), "query_id")


def recent_messages(found: DataFrame, limit: int = 10) -> DataFrame:
    """Numbered list of the newest messages per query, as the digest shows it."""
    top = message_search(found, limit)
    text = F.concat(F.col("rank").cast("string"), F.lit(". ["), F.date_format("received", "yyyy-MM-dd"), F.lit("] "), "subject")
    return top.select("query_id", "rank", text.alias("line"))
