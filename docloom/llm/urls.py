"""URL filters: a trie over reversed host labels, then path segments; the longest fitting entry decides.

The trie of a list that fits the bound is broadcast. A longer list is joined: each url is spelt out into its host's suffixes
and its path's beginnings, as many as it has labels and characters, and these keys meet the entries in a shuffle.

Defined results: a null url or one without `://` has empty host and path, which no entry fits, and gets the default verdict;
of entries of equal length block wins; repeated rows are judged alike; an empty table gives an empty result; other columns
don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Entries (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Longest list whose trie is broadcast; an entry takes under 1 KB.
BROADCAST_ENTRIES = 100_000


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def build_trie(rules) -> dict:
    """Nodes: label -> node; under "/" the node of the path, whose "" holds (rest of a segment, length, blocks, entry)."""
    top: dict = {}
    for verdict, host, path in rules:
        node = top
        for label in reversed(host.split(".")):
            node = node.setdefault(label, {})
        node = node.setdefault("/", {})
        *whole, rest = path.split("/")
        for segment in whole:
            node = node.setdefault("/" + segment, {})
        node.setdefault("", []).append((rest, len(host) + len(path), verdict == "block", host + path))
    return top


def lookup(trie: dict, host: str, path: str) -> tuple[str | None, str | None]:
    """(entry, verdict) of the longest entry that fits."""
    best = None
    node = trie
    segments = path.split("/")
    for label in reversed(host.split(".")):
        node = node.get(label)
        if node is None:
            break
        at = node.get("/")
        for i, segment in enumerate(segments):
            if at is None:
                break
            for rest, length, blocks, entry in at.get("", ()):
                if segment.startswith(rest) and (best is None or (length, blocks) > best[:2]):
                    best = (length, blocks, entry)
            at = at.get("/" + segment) if i + 1 < len(segments) else None
    if best is None:
        return None, None
    return best[2], "block" if best[1] else "allow"


def _by_trie(urls: DataFrame, rules) -> DataFrame:
    trie = urls.sparkSession.sparkContext.broadcast(build_trie(rules))

    @F.pandas_udf("rule string, verdict string")
    def judge(hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
        found = [lookup(trie.value, h, p) for h, p in zip(hosts, paths)]
        return pd.DataFrame(found, columns=["rule", "verdict"], dtype=object)

    return urls.withColumn("hit", judge("host", "path"))


def _by_join(urls: DataFrame, entries: DataFrame) -> DataFrame:
    """For lists beyond the bound: one row per distinct (host, path), its keys, and the best entry of each."""
    pairs = urls.select("host", "path").distinct()
    labels = F.split("host", "\\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    starts = F.transform(F.sequence(F.lit(0), F.length("path")), lambda n: F.substring("path", F.lit(1), n))
    keys = pairs.select("host", "path", F.explode(suffixes).alias("on_host")).select("*", F.explode(starts).alias("on_path"))
    entries = entries.select(
        F.col("host").alias("on_host"),
        F.col("path").alias("on_path"),
        F.struct(
            (F.length("host") + F.length("path")).alias("length"),
            (F.col("verdict") == "block").alias("blocks"),
            F.concat("host", "path").alias("rule"),
            "verdict",
        ).alias("entry"),
    )
    best = keys.join(entries, ["on_host", "on_path"]).groupBy("host", "path").agg(F.max("entry").alias("hit"))
    return urls.join(best, ["host", "path"], "left")


def judge_urls(
    pages: DataFrame,
    rules=RULES,
    default: str = "allow",
    id_col: str = "page_id",
    url_col: str = "url",
    broadcast_entries: int = BROADCAST_ENTRIES,
) -> DataFrame:
    """page_id, host, path, rule, verdict of every row. `rules`: entries, or a DataFrame (verdict, host, path)."""
    urls = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")).select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    if isinstance(rules, DataFrame):
        first = rules.select("verdict", "host", "path").limit(broadcast_entries + 1).collect()
        judged = _by_join(urls, rules) if len(first) > broadcast_entries else _by_trie(urls, [tuple(r) for r in first])
    elif len(rules) > broadcast_entries:
        judged = _by_join(urls, pages.sparkSession.createDataFrame(list(rules), "verdict string, host string, path string"))
    else:
        judged = _by_trie(urls, rules)
    verdict = F.coalesce("hit.verdict", F.lit(default)).alias("verdict")
    return judged.select("page_id", "host", "path", F.col("hit.rule").alias("rule"), verdict)
