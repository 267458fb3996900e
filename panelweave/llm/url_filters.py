"""Judge urls by listed ones: a blocked Bloom filter first, then an exact hash join.

A listed url is a canonical host and a path prefix with a verdict. It fits its host, all
subdomains, and every path that starts with the prefix; the longest listed url wins, of
equally long ones that with the longer host. Each distinct url is expanded into the keys
under which it could be listed; a filter of 256-bit blocks, built and probed with
column functions, drops nearly all keys that are not listed, and an equi-join on the key
itself drops the rest, so a false positive never changes a verdict.

The filter has at most ``BLOCKS`` rows of 40 bytes however long the list is, which is
why it may be broadcast; a longer list only lets more keys through to the exact join.
Missing urls and those without ``://`` have empty host and path. Repeated listed rows
count once; one url listed with two verdicts is an error of the list, and the
alphabetically last verdict (block) wins. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from panelweave.llm.text import ASCII_UPPER

BLOCKS = 1 << 18
WORDS = ("w0", "w1", "w2", "w3")


def host_of(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(_after_scheme(url), r"(?s)^([^/?#]*)", 1)
    return F.translate(host, ASCII_UPPER, ASCII_UPPER.lower())


def path_of(url: Column) -> Column:
    """From the end of the host to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def _block(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BLOCKS)).cast("int")


def _masks(key: Column) -> list[Column]:
    """Eight bits of a block, one in each of its 32-bit halves of four longs."""
    bits = F.xxhash64(key, F.lit("bits"))

    def five(k: int) -> Column:
        return F.shiftrightunsigned(bits, 5 * k).bitwiseAND(F.lit(31)).cast("int")

    def bit(place: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), place)

    return [bit(five(2 * k)).bitwiseOR(bit(five(2 * k + 1) + 32)) for k in range(4)]


def bloom_filter(keys: DataFrame, key: str = "key") -> DataFrame:
    """``block, w0..w3`` for the keys; at most ``BLOCKS`` rows."""
    column = F.col(key)
    rows = keys.select(
        _block(column).alias("block"),
        *[m.alias(w) for m, w in zip(_masks(column), WORDS, strict=True)],
    )
    return rows.groupBy("block").agg(*[F.bit_or(w).alias(w) for w in WORDS])


def possible_hits(rows: DataFrame, bloom: DataFrame, key: str = "key") -> DataFrame:
    """Rows whose key may be among those the filter was built from."""
    column = F.col(key)
    found = rows.withColumn("block", _block(column)).join(F.broadcast(bloom), "block")
    for mask, word in zip(_masks(column), WORDS, strict=True):
        found = found.where(F.col(word).bitwiseAND(mask) == mask)
    return found.select(*rows.columns)


def marked_hits(rows: DataFrame, bloom: DataFrame, key: Column, mark: str) -> DataFrame:
    """All rows, with ``mark`` true where the key may be among those the filter was built from."""
    bits = bloom.select(F.col("block").alias(f"{mark}_block"), *[F.col(w).alias(f"{mark}_{w}") for w in WORDS])
    joined = rows.join(F.broadcast(bits), _block(key) == F.col(f"{mark}_block"), "left")
    hit = F.lit(True)
    for mask, word in zip(_masks(key), WORDS, strict=True):
        hit = hit & (F.col(f"{mark}_{word}").bitwiseAND(mask) == mask)
    return joined.withColumn(mark, F.coalesce(hit, F.lit(False))).drop(f"{mark}_block", *[f"{mark}_{w}" for w in WORDS])


def judge_urls(urls: DataFrame, listed: DataFrame, default: str = "allow") -> DataFrame:
    """``host, path, rule, verdict`` for the distinct rows of ``urls(host, path)``.

    ``listed`` has ``host``, ``path`` (a prefix) and ``verdict``; ``default`` is the
    verdict of urls that are not listed.
    """
    rules = (
        listed.where("host IS NOT NULL AND path IS NOT NULL")
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .select(F.concat("host", "path").alias("key"), F.length("host").alias("host_length"), "verdict")
    )
    # Both are small whatever the list holds: distinct lengths and one number.
    shape = listed.agg(
        F.sort_array(F.collect_set(F.length("path"))).alias("lengths"),
        F.max(F.size(F.split("host", r"\."))).alias("labels"),
    ).first()
    lengths = F.array(*[F.lit(n) for n in shape["lengths"]]).cast("array<int>")
    most = max(shape["labels"] or 1, 1)

    distinct = urls.select("host", "path").distinct()
    last = F.slice(F.reverse(F.split("host", r"\.")), 1, most)
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(last)),
        lambda n: F.array_join(F.reverse(F.slice(last, 1, n)), "."),
    )
    fitting = F.filter(lengths, lambda n: n <= F.length("path"))
    keys = F.flatten(
        F.transform(
            suffixes,
            lambda s: F.transform(
                fitting,
                lambda n: F.struct(
                    F.concat(s, F.substring(F.col("path"), F.lit(1), n)).alias("key"),
                    F.length(s).alias("host_length"),
                ),
            ),
        )
    )
    candidates = distinct.select("host", "path", F.explode(keys).alias("k")).select(
        "host", "path", "k.key", "k.host_length"
    )
    hits = possible_hits(candidates, bloom_filter(rules)).join(rules, ["key", "host_length"])
    best = hits.groupBy("host", "path").agg(
        F.max(F.struct(F.length("key").alias("size"), "host_length", "key", "verdict")).alias("best")
    )
    return distinct.join(best, ["host", "path"], "left").select(
        "host", "path", F.col("best.key").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )


def filter_urls(pages: DataFrame, listed: DataFrame, default: str = "allow") -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages(page_id, url)``."""
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    judged = judge_urls(rows, listed, default)
    return rows.join(judged.where("rule IS NOT NULL"), ["host", "path"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )
