"""Tags from a dictionary of any size: which of its words each text holds, by joins in place of a test of each word on each text.

A word without white space is in a text if it is in one of its tokens, the parts between white space, and there are far fewer different
tokens than tokens of texts. So words are looked for in each different token once, and a text has what its tokens have. Tokens
of many texts are sent to the texts, as many as KNOWN bytes take; the others, each of few texts, meet theirs by a shuffle. A
word with white space is a candidate where its longest part is in a token, and is then looked for in the text: where the text
lies, if all tokens with candidates can be sent there too, and else in the rows at the end.

In tokens, a word is keyed by that of its character n-grams which fewest of them hold; a token can hold the word only if it holds that
n-gram, so the join of the tokens' n-grams with the keys finds all candidates. A word with an n-gram that no token holds is never
tried. Each different text is moved once, to the place of its hash. Words go by their numbers in order of rank.

Case doesn't count. Words that are null have no part, repeated ones count once, with their smallest rank; the empty word is in
every text that isn't null. A text that is null or holds no word has no tags. Tokens of any length are taken in pieces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators import records
from corpusloom.operators.names import col, free, own

#: Characters of a key (a shorter word is its own key), and of a piece of a text whose n-grams are made at once.
GRAM = 3
PIECE = 1 << 20
#: Bytes of the tokens that are sent to all texts.
KNOWN = 32 << 20
SPACE = r"[\x09-\x0D\x20]+"


def _grams(text: Column, n: int) -> Column:
    """The n-grams of ``text``; each text has the empty one."""
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))"), 1) if n else F.array(F.lit(""))


def _texts_grams(texts: DataFrame, sizes: list[int]) -> DataFrame:
    """(hash, gram) of ``texts`` (hash, text), distinct within a piece; pieces overlap, so no n-gram is lost."""
    starts = F.sequence(F.lit(1), F.greatest(F.length("text"), F.lit(1)), F.lit(PIECE))
    pieces = texts.select("hash", "text", F.explode(starts).alias("at"))
    pieces = pieces.select("hash", F.substring("text", F.col("at"), F.lit(PIECE + GRAM - 1)).alias("piece"))
    return pieces.select("hash", F.explode(F.array_distinct(F.concat(*(_grams(F.col("piece"), n) for n in sizes)))).alias("gram"))


def keyed_words(texts: DataFrame, words: DataFrame, sizes: list[int]) -> DataFrame:
    """(gram, word, rank) of the ``words`` (word, rank) that ``texts`` (hash, text) may hold, each by its rarest n-gram."""
    size = f"least(length(word), {GRAM})"
    grams = F.expr(f"array_distinct(transform(sequence(1, length(word) - {size} + 1), i -> substring(word, i, {size})))")
    each = words.select("word", "rank", F.explode(grams).alias("gram"))
    held = _texts_grams(texts, sizes).groupBy("gram").agg(F.count("*").alias("n"))
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("rarest")
    return each.join(held, "gram", "left").groupBy("word", "rank").agg(rarest).filter("rarest.n > 0").select("rarest.gram", "word", "rank")


def _tokens(text: Column) -> Column:
    """The different tokens of ``text``, the empty one among them."""
    return F.array_distinct(F.concat(F.split(text, SPACE), F.array(F.lit(""))))


def _longest(text: Column) -> Column:
    """The longest token of ``text``, the first by code points if there are several."""
    return F.array_min(F.transform(F.split(text, SPACE), lambda x: F.struct((-F.length(x)).alias("size"), x.alias("part"))))["part"]


def known_tokens(texts: DataFrame, words: DataFrame, sizes: list[int], folder: str) -> DataFrame:
    """(token, n, ids, maybe) of the tokens of ``texts`` (text) that hold the ``part`` of one of the ``words`` (word, id, part).

    n texts have the token; ids are of words that are their own part, maybe has (id, word) of the others; null where there are none.
    """
    read = texts.sparkSession.read.parquet
    texts.select(F.explode(_tokens(F.col("text"))).alias("token")).groupBy("token").agg(F.count("*").alias("n")).write.parquet(f"{folder}/tokens")
    tokens = read(f"{folder}/tokens").select(F.struct("token", "n").alias("hash"), F.col("token").alias("text"))
    parts = words.select(F.col("part").alias("word"), F.lit(0).alias("rank")).distinct()
    keys = keyed_words(tokens, parts, sizes).select("gram", F.col("word").alias("part")).join(words, "part")
    keys.write.parquet(f"{folder}/keys")
    tried = _texts_grams(tokens, sizes).join(read(f"{folder}/keys"), "gram")
    held = tried.filter(F.contains("hash.token", "part") & ((F.col("part") != "") | (F.col("hash.token") == ""))).groupBy("hash")
    some = lambda x: F.when(F.size(x) > 0, x)
    ids = some(F.collect_set(F.when(F.col("part") == F.col("word"), F.col("id"))))
    maybe = some(F.collect_set(F.when(F.col("part") != F.col("word"), F.struct("id", "word"))))
    held.agg(ids.alias("ids"), maybe.alias("maybe")).select("hash.*", "ids", "maybe").write.parquet(f"{folder}/known")
    return read(f"{folder}/known")


def _found(texts: DataFrame, known: DataFrame, folder: str) -> tuple[DataFrame, bool]:
    """(hash, ids, maybe) of ``texts`` (hash, text), by what the tokens of each have in ``known``; whether maybe can have any.

    The ids of a text are there once each, its candidates perhaps several times.
    """
    level = F.length(F.bin("n"))  # of tokens of as many texts, up to a factor of two
    size = F.length("token") + 4 * F.greatest(F.size("ids"), F.lit(0)) + 48 * F.greatest(F.size("maybe"), F.lit(0)) + 64
    unsure = F.col("maybe").isNotNull()
    taken = known.groupBy(level.alias("level")).agg(F.sum(size).alias("all"), F.coalesce(F.sum(F.when(unsure, size)), F.lit(0)).alias("unsure"))
    levels = sorted(((r["level"], r["all"], r["unsure"]) for r in taken.collect()), reverse=True)  # 64 at most
    all_sent = sum(x for *_, x in levels) <= KNOWN
    least = min((at for i, (at, *_) in enumerate(levels) if sum(x for _, x, _ in levels[: i + 1]) <= KNOWN), default=65)
    with_texts = (level >= least) | (unsure & F.lit(all_sent))
    each = texts.select("hash", F.explode(_tokens(F.col("text"))).alias("token"))
    sent = F.broadcast(known.filter(with_texts).select("token", "ids", "maybe", F.lit(True).alias("met")))
    met = each.join(sent, "token", "left").groupBy("hash").agg(
        F.collect_list("ids").alias("ids"), F.collect_list("maybe").alias("maybe"), F.collect_list(F.when(F.col("met").isNull(), F.col("token"))).alias("others")
    )
    met = met.select("hash", F.array_distinct(F.flatten("ids")).alias("ids"), F.flatten("maybe").alias("maybe"), "others")
    if all_sent and any(x for *_, x in levels):
        held = F.transform(F.filter("maybe", lambda x: F.contains("text", x["word"])), lambda x: x["id"])
        met = met.join(texts, "hash").select("hash", F.array_distinct(F.concat("ids", held)).alias("ids"), F.slice("maybe", 1, 0).alias("maybe"), "others")
    met.withColumn("ids", F.sort_array("ids")).write.parquet(f"{folder}/met")
    met = texts.sparkSession.read.parquet(f"{folder}/met")
    rest = met.select("hash", F.explode("others").alias("token")).join(known.filter(~with_texts), "token").groupBy("hash")
    rest = rest.agg(F.flatten(F.collect_list("ids")).alias("more_ids"), F.flatten(F.collect_list("maybe")).alias("more_maybe"))
    both = lambda c: F.concat(c, F.coalesce(F.col(f"more_{c}"), F.slice(c, 1, 0)))
    return met.join(rest, "hash", "left").select("hash", F.array_distinct(both("ids")).alias("ids"), both("maybe").alias("maybe")), not all_sent


def dictionary_tags(
    rows: DataFrame, text: Column, words: DataFrame, word: Column, rank: Column, folder: str, limit: int | None = None, name: str = "tags", count: str | None = None
) -> DataFrame:
    """``rows`` with the lower-cased words that ``text`` holds, as an array by rank and then by word, of ``limit`` at most.

    With ``count``, also with a column of that name: how many words it holds, whatever the limit. The words, the tokens and what
    was found are kept in ``folder``, a new one that all executors share.
    """
    added = [name] if count is None else [name, count]
    hashed, all_, first, perhaps, held = free([*rows.columns, *added], "_hash", "_all", "_first", "_perhaps", "_held")
    kept = [c for c, n in zip(own(rows), rows.columns, strict=True) if n.lower() not in map(str.lower, added)]
    ranked = words.select(F.lower(word).alias("word"), rank.alias("rank")).filter("word IS NOT NULL").groupBy("word").agg(F.min("rank").alias("rank"))
    ranked = ranked.withColumn("part", _longest(F.col("word")))
    sizes = sorted(r[0] for r in ranked.select(F.least(F.length("part"), F.lit(GRAM))).distinct().collect())  # GRAM + 1 values at most
    number = lambda x: [x.cast("bigint").alias(count)] if count else []
    if not sizes:
        return rows.select(*kept, F.array().cast("array<string>").alias(name), *number(F.lit(0)))
    placed = records.numbered(ranked, [F.col("rank"), F.col("word")], "id", f"{folder}/order")
    placed.select("word", F.col("id").cast("int").alias("id"), "part").write.parquet(f"{folder}/words")
    known = rows.sparkSession.read.parquet(f"{folder}/words")
    read = rows.withColumn(hashed, F.unhex(F.substring(F.sha2(F.lower(text), 256), 1, 32)))
    present = read.filter(col(hashed).isNotNull()).select(col(hashed).alias("hash"), F.lower(text).alias("text"))
    tokens = known_tokens(present, known, sizes, folder)
    found, unsure = _found(present.groupBy("hash").agg(F.first("text").alias("text")), tokens, folder)
    top = F.sort_array("ids") if limit is None else F.slice(F.sort_array("ids"), 1, limit)
    named = found.select("hash", F.size("ids").alias("n"), "maybe", F.explode_outer(top).alias("id")).join(known.select("id", "word"), "id", "left")
    tagged = named.groupBy(F.col("hash").alias(hashed)).agg(
        F.first("n").alias(all_), F.collect_list(F.when(F.col("id").isNotNull(), F.struct("id", "word"))).alias(first), F.sort_array(F.first("maybe")).alias(perhaps)
    )
    if not unsure:  # then the text has no part any more
        joined = read.join(tagged.withColumnRenamed(perhaps, held), hashed, "left")
    else:
        once = lambda x, i: (i == 0) | (x["id"] != F.get(col(perhaps), i - 1)["id"])
        joined = read.join(tagged.withColumn(perhaps, F.filter(col(perhaps), once)), hashed, "left")
        joined = joined.withColumn(held, F.filter(col(perhaps), lambda x: F.contains(F.lower(text), x["word"])))
    order = F.sort_array(F.concat(col(first), col(held)))
    tags = F.transform(order if limit is None else F.slice(order, 1, limit), lambda x: x["word"])
    return joined.select(*kept, F.coalesce(tags, F.array().cast("array<string>")).alias(name), *number(F.coalesce(col(all_) + F.size(held), F.lit(0))))
