"""Name search (P8) by a character-trigram index.

``name_grams`` has a row (gram, productId) for every different three characters of a name, laid out by gram;
``products_by_id`` has the product rows laid out by id. A pattern's literal parts give trigrams that every match must
contain; the postings of those grams give the candidates, whose rows alone are read, and the pattern confirms them. A
pattern without such a part (or with syntax that ``literal_grams`` doesn't know) is searched by a scan, so the
result is always that of ``rlike`` over all names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pickwise.sources.keyed import current_keyed, publish_keyed

GRAM = 3
#: Patterns with more different grams than this are searched by a scan.
MOST_GRAMS = 256


def literal_grams(pattern: str) -> list[set[str]] | None:
    """For each alternative of the pattern the grams that a match must contain; None where an alternative has none.

    Only what is certain counts: runs of plain characters outside groups, classes and braces, without a
    character that a quantifier makes optional. Inline flags and quoted parts aren't looked into."""
    if any(x in pattern for x in ("(?", "\\Q", "[]", "[^]")) or "|" in pattern and "(" in pattern:
        return None
    out = []
    for alternative in _alternatives(pattern):
        grams = {run[i:i + GRAM] for run in _runs(alternative) for i in range(len(run) - GRAM + 1)}
        if not grams:
            return None
        out.append(grams)
    return out if sum(map(len, out)) <= MOST_GRAMS else None


def _alternatives(pattern: str) -> list[str]:
    """The pattern cut at its bars (those of a class or after a backslash aren't bars)."""
    parts, inside, k = [""], False, 0
    while k < len(pattern):
        c = pattern[k]
        if c == "\\":
            parts[-1] += pattern[k:k + 2]
            k += 2
            continue
        inside = (inside or c == "[") and c != "]"
        if c == "|" and not inside:
            parts.append("")
        else:
            parts[-1] += c
        k += 1
    return parts


def _runs(pattern: str) -> list[str]:
    """Runs of plain characters that a match of the bar-free pattern must contain."""
    runs, depth, k = [""], 0, 0
    while k < len(pattern):
        c = pattern[k]
        if c == "\\":
            following = pattern[k + 1:k + 2]
            if depth or not following or following.isalnum():
                runs.append("")  # a class, an anchor or a code
            else:
                runs[-1] += following
            k += 2
            continue
        if c == "[":
            end = _class_end(pattern, k)
            runs.append("")
            k = end
            continue
        if c in "()":
            depth += 1 if c == "(" else -1
            runs.append("")
        elif depth:
            pass
        elif c in "?*{":
            runs[-1] = runs[-1][:-1]  # the character before may be missing
            runs.append("")
            if c == "{":
                k = pattern.find("}", k) if "}" in pattern[k:] else len(pattern)
        elif c in ".^$+":
            runs.append("")
        else:
            runs[-1] += c
        k += 1
    return runs


def _class_end(pattern: str, begin: int) -> int:
    """The place after the class that begins at ``begin`` (nested classes included)."""
    depth, k = 0, begin
    while k < len(pattern):
        if pattern[k] == "\\":
            k += 2
            continue
        depth += {"[": 1, "]": -1}.get(pattern[k], 0)
        k += 1
        if not depth:
            break
    return k


def name_grams(products: DataFrame) -> DataFrame:
    """gram, productId."""
    places = F.sequence(F.lit(1), F.char_length("name") - (GRAM - 1))
    grams = F.array_distinct(F.transform(places, lambda i: F.substring("name", i, F.lit(GRAM))))
    return products.where(F.char_length("name") >= GRAM).select(F.explode(grams).alias("gram"), "productId")


def publish_name_index(spark: SparkSession, root: str, products: DataFrame) -> None:
    """Write both tables as their next versions."""
    publish_keyed(spark, f"{root}/products_by_id", products, "productId")
    publish_keyed(spark, f"{root}/name_grams", name_grams(products), "gram")


def candidates(spark: SparkSession, root: str, alternatives: list[set[str]]) -> DataFrame:
    """productId of the names that contain all grams of an alternative; reads the postings of these grams only."""
    wanted = sorted(set().union(*alternatives))
    asked = spark.createDataFrame([(g,) for g in wanted], "gram string")
    postings = current_keyed(spark, f"{root}/name_grams", "gram")
    found = postings.part(postings.touched(asked)).where(F.col("gram").isin(wanted))
    of_product = found.groupBy("productId").agg(F.collect_set("gram").alias("grams"))  # MOST_GRAMS at most
    whole = F.lit(False)
    for grams in alternatives:
        whole = whole | (F.size(F.array_except(F.array(*[F.lit(g) for g in sorted(grams)]), "grams")) == 0)
    return of_product.where(whole).select("productId")


def search(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """The products whose name the pattern matches anywhere (case-sensitive)."""
    table = current_keyed(spark, f"{root}/products_by_id", "productId")
    alternatives = literal_grams(pattern)
    rows = table.all() if alternatives is None else table.of_keys(candidates(spark, root, alternatives))
    return rows.where(F.col("name").rlike(pattern))
