"""License scans by a positional index of rare words (operator 12), native throughout.

Words are runs of digits, letters and characters beyond ASCII, lower-cased in A-Z. The
templates below are an index: each of their words, but the commonest of the language, has
postings (template, place). Per file:

1. The words that occur in a template or a key phrase are noted with their places; the
   rest of the text is not needed any more. Key phrases are found among them by
   consecutive places.
2. A word's weight is its inverse document frequency over all files, in thousandths, plus
   one. The TOP_WORDS heaviest of a file's index words are looked up.
3. Each occurrence meets the word's postings; the difference of the two places is where
   the template would begin. Beginnings are gathered in bins of BIN words, once more
   shifted by half a bin, so that words inserted or left out do not part them. A template
   stands in a bin if the distinct words met there hold SHARE of the template's weight
   and its mandatory key phrases are in the bin too.

Base labels come from three phrases alone and always stay. The score is the largest
share of a template that stands, and at least BASE_SCORE where a base phrase does.

Files are rows: only a row's license words are written, exploded and added up by row,
template and bin, sets of words being no larger than the vocabulary. Weights are one
number per word of the vocabulary, the only thing the driver sees.

Defined cases: null and empty texts and texts without words have no words, labels or
places, and score 0; each row is a file of its own, so repeated rows give repeated
results and count as often in the weights; keys may be null; an empty table gives an
empty result. Equal weights are ordered by the word. Columns other than key and text are
never read, so their names cannot clash.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.llm.common import scan, written

WORD = r"[0-9A-Za-z\x80-\x{10FFFF}]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Words looked up per file, words per bin of beginnings, and the share of a template's
# weight (in tenths) from which on it stands.
TOP_WORDS = 48
BIN = 32
SHARE_TENTHS = 6
BASE_SCORE = 0.5

# The base phrases, words without postings, and notices with their labels
# and mandatory key phrases.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
COMMON = "a an and any as at be by for in is it of on or that the this to with you".split()


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    needs: tuple[str, ...]


TEMPLATES = (
    Template("mit", "released under the mit license", ("mit license",)),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
        " documentation files the software to deal in the software without restriction including without limitation"
        " the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to"
        " permit persons to whom the software is furnished to do so subject to the following conditions the above"
        " copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
        ("hereby granted free", "shall be included in all copies"),
    ),
    Template("apache", "licensed under the apache license version 2 0", ("apache license version 2",)),
    Template(
        "apache",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with"
        " the license you may obtain a copy of the license at unless required by applicable law or agreed to in writing"
        " software distributed under the license is distributed on an as is basis without warranties or conditions of"
        " any kind either express or implied see the license for the specific language governing permissions and"
        " limitations under the license",
        ("apache license", "in compliance with the license"),
    ),
    Template("gpl", "licensed under the gnu general public license version 3", ("gnu general public license",)),
    Template(
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general"
        " public license as published by the free software foundation either version 3 of the license or at your option"
        " any later version this program is distributed in the hope that it will be useful but without any warranty"
        " without even the implied warranty of merchantability or fitness for a particular purpose",
        ("gnu general public license", "free software foundation"),
    ),
    Template(
        "lgpl",
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser"
        " general public license as published by the free software foundation either version 3 of the license or at"
        " your option any later version",
        ("lesser general public license",),
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the"
        " following conditions are met redistributions of source code must retain the above copyright notice this list of"
        " conditions and the following disclaimer redistributions in binary form must reproduce the above copyright"
        " notice this list of conditions and the following disclaimer in the documentation and or other materials"
        " provided with the distribution",
        ("source and binary forms", "following conditions are met"),
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby"
        " granted provided that the above copyright notice and this permission notice appear in all copies",
        ("with or without fee is hereby granted",),
    ),
    Template(
        "mpl",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not"
        " distributed with this file you can obtain one at",
        ("mozilla public license",),
    ),
    Template(
        "unlicense",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use"
        " compile sell or distribute this software",
        ("free and unencumbered software",),
    ),
    Template("cc-by", "licensed under cc by 4 0", ("cc by 4",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-nd", "licensed under cc by nd 4 0", ("cc by nd",)),
)


def array(values: list, kind: str) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>")


class Index:
    """Numbers of words and phrases, and their postings (template, place)."""

    def __init__(self, templates: tuple[Template, ...], base: tuple[tuple[str, str], ...]) -> None:
        self.templates, self.base = templates, base
        bodies = [t.text.split() for t in templates]
        self.phrases = list(dict.fromkeys([p for p, _ in base] + [p for t in templates for p in t.needs]))
        self.words = sorted({w for text in [*(t.text for t in templates), *self.phrases] for w in text.split()})
        number = {w: k for k, w in enumerate(self.words)}
        self.spelled = [[number[w] for w in p.split()] for p in self.phrases]
        self.word_postings: list[list[tuple[int, int]]] = [[] for _ in self.words]
        self.phrase_postings: list[list[tuple[int, int]]] = [[] for _ in self.phrases]
        for t, body in enumerate(bodies):
            for place, word in enumerate(body):
                if word not in COMMON:
                    self.word_postings[number[word]].append((t, place))
            for need in templates[t].needs:
                n = len(need.split())
                places = [k for k in range(len(body)) if " ".join(body[k : k + n]) == need]
                self.phrase_postings[self.phrases.index(need)] += [(t, k) for k in places]

    def weights(self, files: int, having: dict[int, int]) -> list[int]:
        """Per word: thousandths of its inverse document frequency, plus one."""
        return [1 + math.floor(1000 * math.log((files + 1) / (having.get(k, 0) + 1)) + 0.5) for k in range(len(self.words))]

    def total(self, t: int, weights: list[int]) -> int:
        return sum(w for w, postings in zip(weights, self.word_postings) if any(t == x for x, _ in postings))


def postings_column(postings: list[list[tuple[int, int]]]) -> Column:
    kind = "array<array<struct<t:int,place:int>>>"
    return F.array(*[F.array(*[F.struct(F.lit(t), F.lit(k)) for t, k in p]).cast("array<struct<t:int,place:int>>") for p in postings]).cast(kind)


def license_words(docs: DataFrame, key: str, text: str, index: Index) -> DataFrame:
    """_row, _key, n_words, hits (word, place) and phrases (phrase, place) of each row."""
    words = F.regexp_extract_all(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit(WORD), F.lit(0))
    split = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(key).alias("_key"), words.alias("_words"))
    # lower() is quick, but it also lowers letters beyond ASCII: the few words it finds are
    # looked up as they are in A-Z
    places = F.array_compact(F.transform("_words", lambda w, i: F.when(F.lower(w).isin(index.words), i)))
    names = array(index.words, "string")

    def hit(i: Column) -> Column:
        word = F.translate(F.get("_words", i), UPPER, LOWER)
        return F.struct((F.array_position(names, word) - 1).cast("int").alias("word"), i.alias("place"))

    known = F.filter(F.transform(places, hit), lambda h: h["word"] >= 0)
    noted = split.select("_row", "_key", F.size("_words").cast("long").alias("n_words"), known.alias("hits"))

    def starts(number: int, spelled: list[int]) -> Column:
        def here(h: Column, i: Column) -> Column:
            same = h["word"] == spelled[0]
            for k, word in enumerate(spelled[1:], 1):
                following = F.get("hits", i + k)
                same = same & (following["word"] == word) & (following["place"] == h["place"] + k)
            return same

        return F.transform(F.filter("hits", here), lambda h: F.struct(F.lit(number).alias("phrase"), h["place"].alias("place")))

    return noted.withColumn("phrases", F.concat(*[starts(number, spelled) for number, spelled in enumerate(index.spelled)]))


def standing(noted: DataFrame, index: Index, weights: list[int]) -> DataFrame:
    """_row, _labels, _share of the templates that stand in a row."""
    weight, is_index = array(weights, "long"), [k for k, p in enumerate(index.word_postings) if p]
    own = F.array_intersect(F.array_distinct("hits.word"), array(is_index, "int"))
    heavy = F.slice(F.array_sort(F.transform(own, lambda w: F.struct((-F.get(weight, w)).alias("less"), w.alias("word")))), 1, TOP_WORDS)
    nothing = F.lit(None).cast("int")

    def spots(items: str | Column, number: str, postings: Column) -> Column:
        def met(h: Column) -> Column:
            pair = (h[number], nothing) if number == "word" else (nothing, h[number])
            return F.transform(
                F.get(postings, h[number]),
                lambda p: F.struct(p["t"].alias("t"), (h["place"] - p["place"]).alias("begin"), pair[0].alias("word"), pair[1].alias("phrase")),
            )

        return F.flatten(F.transform(items, met))

    looked_up = F.filter("hits", lambda h: F.array_contains(F.col("_heavy.word"), h["word"]))
    both = F.concat(spots(looked_up, "word", postings_column(index.word_postings)), spots("phrases", "phrase", postings_column(index.phrase_postings)))
    met = noted.where(F.size("hits") > 0).withColumn("_heavy", heavy).select("_row", F.explode(both).alias("s"))
    shifts = F.explode(F.array(F.lit(0), F.lit(BIN // 2))).alias("shift")
    binned = met.select("_row", "s.*", shifts).withColumn("bin", F.floor((F.col("begin") + F.col("shift")) / BIN))
    groups = binned.groupBy("_row", "t", "shift", "bin").agg(F.collect_set("word").alias("words"), F.collect_set("phrase").alias("found"))
    needed = [array([index.phrases.index(p) for p in t.needs], "int") for t in index.templates]
    needs = F.get(F.array(*needed), F.col("t"))
    matched = F.aggregate("words", F.lit(0).cast("long"), lambda acc, w: acc + F.get(weight, w))
    total = F.get(array([index.total(t, weights) for t in range(len(index.templates))], "long"), F.col("t"))
    judged = groups.where(F.size(F.array_except(needs, "found")) == 0).select("_row", "t", matched.alias("matched"), total.alias("total"))
    kept = judged.where(F.col("matched") * 10 >= F.col("total") * SHARE_TENTHS)
    label = F.get(array([t.label for t in index.templates], "string"), F.col("t"))
    return kept.groupBy("_row").agg(F.collect_set(label).alias("_labels"), F.max(F.col("matched") / F.col("total")).alias("_share"))


def license_scan(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    templates: tuple[Template, ...] = TEMPLATES,
    base: tuple[tuple[str, str], ...] = BASE,
) -> DataFrame:
    """One row per document: key, n_words, n_base, first_word, last_word, base_labels,
    labels, score, and phrases (all key phrases found, with their places)."""
    index = Index(templates, base)
    noted = written(license_words(docs, key, text, index), "license-words")
    files = noted.count()
    having = noted.select(F.explode(F.array_distinct("hits.word")).alias("word")).groupBy("word").count()
    # one row per word of the vocabulary at most
    weights = index.weights(files, {r["word"]: r["count"] for r in having.collect()})
    stands = standing(noted, index, weights)
    basic = F.filter("phrases", lambda p: p["phrase"] < len(base))
    table = noted.select("_row", "_key", "n_words", "phrases", basic.alias("_basic")).join(stands, "_row", "left")
    base_labels = F.array_sort(F.array_distinct(F.transform("_basic", lambda p: F.get(array([label for _, label in base], "string"), p["phrase"]))))
    floor = F.when(F.size("_basic") > 0, BASE_SCORE).otherwise(0.0)
    names = F.transform("phrases", lambda p: F.struct(F.get(array(index.phrases, "string"), p["phrase"]).alias("phrase"), p["place"].alias("place")))
    return table.withColumn("_base", base_labels).select(
        F.col("_key").alias(key),
        "n_words",
        F.size("_basic").cast("long").alias("n_base"),
        F.array_min("_basic.place").cast("long").alias("first_word"),
        F.array_max("_basic.place").cast("long").alias("last_word"),
        F.array_join("_base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("_base", F.coalesce("_labels", F.array().cast("array<string>")))), ",").alias("labels"),
        F.greatest(floor, F.coalesce("_share", F.lit(0.0))).alias("score"),
        names.alias("phrases"),
    )


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(scan(spark, sf_dir, "documents")).drop("phrases")


def oracle() -> str:
    """The same from the templates' texts, with words and phrases joined as they are."""
    bodies = ", ".join(f"({t}, '{x.label}', '{x.text}')" for t, x in enumerate(TEMPLATES))
    needs = ", ".join(f"({t}, '{p}')" for t, x in enumerate(TEMPLATES) for p in x.needs)
    base = ", ".join(f"('{p}', '{label}')" for p, label in BASE)
    common = ", ".join(f"'{w}'" for w in COMMON)
    return f"""
WITH templates(t, label, body) AS (VALUES {bodies}),
needs(t, phrase) AS (VALUES {needs}),
base(phrase, label) AS (VALUES {base}),
spelled AS (SELECT t, label, string_split(body, ' ') AS w FROM templates),
postings AS (
  SELECT * FROM (SELECT t, unnest(w) AS word, unnest(range(len(w))) AS place FROM spelled) WHERE word NOT IN ({common})
), phrases AS (
  SELECT phrase, string_split(phrase, ' ') AS p FROM (SELECT phrase FROM needs UNION SELECT phrase FROM base)
), phrase_postings AS (
  SELECT n.t, n.phrase, place
  FROM needs n JOIN spelled s USING (t), unnest(range(len(s.w))) AS r(place)
  WHERE array_to_string(s.w[place + 1 : place + len(string_split(n.phrase, ' '))], ' ') = n.phrase
), files AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents
), words AS (
  SELECT r, unnest(w) AS word, unnest(range(len(w))) AS place FROM files
), found AS (
  SELECT x.r, p.phrase, x.place
  FROM words x JOIN phrases p ON x.word = p.p[1] JOIN files f ON f.r = x.r
  WHERE array_to_string(f.w[x.place + 1 : x.place + len(p.p)], ' ') = p.phrase
), hits AS (
  SELECT * FROM words WHERE word IN (SELECT word FROM postings)
), weights AS (
  SELECT word, 1 + CAST(floor(1000 * ln(((SELECT count(*) FROM files) + 1) / (coalesce(n, 0) + 1)) + 0.5) AS BIGINT) AS weight
  FROM (SELECT DISTINCT word FROM postings)
  LEFT JOIN (SELECT word, count(DISTINCT r) AS n FROM hits GROUP BY word) USING (word)
), heavy AS (
  SELECT r, word, weight FROM (SELECT DISTINCT r, word FROM hits) JOIN weights USING (word)
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY weight DESC, word) <= {TOP_WORDS}
), spots AS (
  SELECT h.r, p.t, h.place - p.place AS start, h.word, NULL AS phrase
  FROM hits h JOIN heavy USING (r, word) JOIN postings p USING (word)
  UNION ALL
  SELECT f.r, p.t, f.place - p.place, NULL, f.phrase FROM found f JOIN phrase_postings p USING (phrase)
), binned AS (
  SELECT DISTINCT r, t, shift, floor((start + shift) / {BIN}) AS bin, word, phrase
  FROM spots, (VALUES (0), ({BIN // 2})) AS s(shift)
), judged AS (
  SELECT r, t, sum(weight) AS matched, count(DISTINCT phrase) AS n
  FROM binned LEFT JOIN weights USING (word) GROUP BY r, t, shift, bin
), totals AS (
  SELECT t, sum(weight) AS total FROM (SELECT DISTINCT t, word FROM postings) JOIN weights USING (word) GROUP BY t
), stands AS (
  SELECT r, list(DISTINCT label) AS labels, max(CAST(matched AS DOUBLE) / CAST(total AS DOUBLE)) AS share
  FROM judged JOIN totals USING (t) JOIN templates USING (t)
  WHERE n = (SELECT count(*) FROM needs WHERE needs.t = judged.t) AND matched * 10 >= total * {SHARE_TENTHS}
  GROUP BY r
), basic AS (
  SELECT r, count(*) AS n, min(place) AS lo, max(place) AS hi, list(DISTINCT label) AS labels
  FROM found JOIN base USING (phrase) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, lo AS first_word, hi AS last_word,
       coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(s.labels, [])))), ',') AS labels,
       greatest(CASE WHEN b.r IS NULL THEN 0.0 ELSE {BASE_SCORE} END, coalesce(share, 0.0))::DOUBLE AS score
FROM files LEFT JOIN basic b USING (r) LEFT JOIN stands s USING (r)
"""


ORACLE = oracle()
