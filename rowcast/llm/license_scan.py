"""License scan by diagonal voting (DataFrame functions only).

Every run of ``k`` words of a text is hashed and joined with the positions of
the same runs in license templates. A match at word ``p`` of the text and
``q`` of the template votes for diagonal ``p - q``; a copied template gathers
its votes on one diagonal, one with words added or left out on neighbouring
ones. Votes are counted per diagonal, neighbouring diagonals merged, and a
span is verified by its words: every vote's words must equal the template's,
enough of the template must be covered, and the span must be as long as that.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowcast.llm.common import HOT_KEYS, stored

K = 3
BROADCAST_RUNS = 200_000  # template runs up to which the join may broadcast them (about 20 MB)
SALTS = 32  # parts over which the places of a hot run are dealt

# Phrases whose consecutive words give a label by themselves.
BASE_PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Notices as their licenses word them.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("apache-2.0", "distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND"),
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "Released under the BSD License"),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    ("gpl-2.0", "licensed under the GNU General Public License, version 2"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("cc-by-4.0", "Licensed under CC BY 4.0"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nd-4.0", "Licensed under CC BY-ND 4.0"),
    ("cc0", "No rights reserved. Released into the public domain under CC0"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
            "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
            "copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("bsd-2-clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
                     "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
                     "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
                     "documentation and/or other materials provided with the distribution."),
    ("bsd-3-clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                     "promote products derived from this software without specific prior written permission."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
                   "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
                   "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
                   "permissions and limitations under the License."),
    ("gpl-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                         "General Public License as published by the Free Software Foundation, either version 3 of the License, "
                         "or (at your option) any later version. This program is distributed in the hope that it will be "
                         "useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR "
                         "A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("gpl-2.0-or-later", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                         "General Public License as published by the Free Software Foundation; either version 2 of the License, "
                         "or (at your option) any later version."),
]


def default_templates(spark: SparkSession) -> DataFrame:
    """``label, text`` of :data:`TEMPLATES`."""
    rows = [F.struct(F.lit(a).alias("label"), F.lit(b).alias("text")) for a, b in TEMPLATES]
    return spark.range(1).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def normal_words(text: Column) -> Column:
    """The text's words joined by single blanks, A-Z lower-cased; null: empty.

    The two letters outside ASCII whose lower case holds an ASCII letter (the
    Kelvin sign and the dotted capital I) are first replaced by others that
    have none, so that lower-casing maps no other letter into ASCII.
    """
    plain = F.coalesce(text, F.lit(""))
    for odd in ("K", "İ"):
        plain = F.replace(plain, F.lit(odd), F.lit("ı"))
    return F.trim(F.regexp_replace(F.lower(plain), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))


def _words(normal: Column) -> Column:
    return F.when(normal == "", F.array().cast("array<string>")).otherwise(F.split(normal, " "))


def _runs(words: Column, n: Column, k: int) -> Column:
    """Hash of every run of ``k`` words."""
    at = lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(k)])
    return F.when(n >= k, F.transform(F.sequence(F.lit(0), n - k), at)).otherwise(F.array().cast("array<bigint>"))


def _phrase_starts(normal: Column, words: Column, n: Column, phrase: str) -> Column:
    """Word numbers at which ``phrase`` begins; looked for only where it occurs."""
    parts = phrase.split(" ")
    here = lambda i: reduce(lambda a, b: a & b, [F.get(words, i + j) == w for j, w in enumerate(parts)])
    seen = F.contains(F.concat(F.lit(" "), normal, F.lit(" ")), F.lit(f" {phrase} "))
    return F.when(seen, F.filter(F.sequence(F.lit(0), n - len(parts)), here)).otherwise(
        F.array().cast("array<int>")
    )


def template_runs(templates: DataFrame, k: int = K) -> DataFrame:
    """``template, label, t_words, t_runs, q, hash, run``: the runs of every
    template of at least ``k`` words."""
    words = templates.select(
        F.xxhash64("label", "text").alias("template"), "label", _words(normal_words(F.col("text"))).alias("w")
    ).distinct()
    sized = words.withColumn("t_words", F.size("w")).where(F.col("t_words") >= k)
    return sized.select(
        "template",
        "label",
        "t_words",
        (F.col("t_words") - k + 1).alias("t_runs"),
        "w",
        F.posexplode_outer(_runs(F.col("w"), F.col("t_words"), k)).alias("q", "hash"),
    ).withColumn("run", F.array_join(F.slice("w", F.col("q") + 1, k), " ")).drop("w")


def votes(docs: DataFrame, templates: DataFrame, k: int = K, base: dict[str, str] | None = None,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document (``p`` null) with its base columns, and one per
    vote (``p``, ``q``, template columns). ``row`` numbers the documents."""
    base = BASE_PHRASES if base is None else base
    runs = template_runs(templates, k)
    few = runs.count() <= BROADCAST_RUNS
    none = F.array().cast("array<int>")
    text = docs.select(
        docs[id_col].alias("doc_id"), F.monotonically_increasing_id().alias("row"), normal_words(docs[text_col]).alias("normal")
    )
    split = text.withColumn("w", _words(F.col("normal")))
    split = split.withColumn("n", F.size("w"))
    found = split.select(
        "doc_id", "row", "w", "n",
        *[
            _phrase_starts(F.col("normal"), F.col("w"), F.col("n"), phrase).alias(f"base_{i}")
            for i, phrase in enumerate(base)
        ],
    )
    starts = F.concat(none, *[F.col(f"base_{i}") for i in range(len(base))])
    labels = F.concat(
        F.array().cast("array<string>"),
        *[
            F.when(F.size(f"base_{i}") > 0, F.array(F.lit(label))).otherwise(F.array().cast("array<string>"))
            for i, label in enumerate(base.values())
        ],
    )
    told = found.select(
        "doc_id", "row", "w", "n", F.size(starts).alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"), labels.alias("base_labels"),
        _runs(F.col("w"), F.col("n"), k).alias("runs"),
    )
    return _broadcast_votes(told, runs, k) if few else _shuffled_votes(told, runs, k)


OWN = ("doc_id", "n", "n_base", "first_word", "last_word", "base_labels")
VOTE = ("q", "template", "label", "t_words", "t_runs")


def _broadcast_votes(told: DataFrame, runs: DataFrame, k: int) -> DataFrame:
    """The template's runs go to every task, and no text is shuffled."""
    # Entry 0 stands for the document itself, so one pass gives both kinds of rows.
    entries = told.withColumn("runs", F.concat(F.array(F.lit(0).cast("long")), "runs"))
    exploded = entries.select(
        "row", "w", *OWN,
        # The outer form: for the inner one the optimizer adds a filter that
        # builds the runs a second time, splitting the text at every word.
        F.posexplode_outer("runs").alias("at", "d_hash"),
    )
    joined = exploded.join(F.broadcast(runs), (F.col("at") > 0) & (F.col("d_hash") == F.col("hash")), "left").where(
        (F.col("at") == 0) | (F.array_join(F.slice("w", F.greatest("at", F.lit(1)), k), " ") == F.col("run"))
    )
    own = lambda c: F.when(F.col("at") == 0, F.col(c)).alias(c)
    return joined.select("row", *map(own, OWN), F.when(F.col("at") > 0, F.col("at") - 1).alias("p"), *VOTE)


def _shuffled_votes(told: DataFrame, runs: DataFrame, k: int) -> DataFrame:
    """For template sets that are too large for every task.

    Only row, position and hash of a run are shuffled. Runs that very many
    places share are dealt by place over ``SALTS`` parts of their own, so no
    task gets all of them. The words of the documents join once, by row, to
    verify what the hashes found.
    """
    told = stored(told, "license-words")
    places = stored(
        told.select("row", F.posexplode_outer("runs").alias("p", "hash")).where("hash is not null"), "license-runs"
    )
    often = F.count(F.lit(1)) * HOT_KEYS > places.count()
    hot = stored(places.groupBy("hash").agg(often.alias("hot")).where("hot"), "license-hot")  # fewer than HOT_KEYS
    part = F.when(F.col("hot"), F.pmod(F.xxhash64("row", "p"), F.lit(SALTS)).cast("int")).otherwise(0).alias("part")
    dealt = places.join(F.broadcast(hot), "hash", "left").select("row", "p", "hash", part)
    parts = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    spread = runs.join(F.broadcast(hot), "hash", "left").select(*VOTE, "hash", "run", F.explode(parts).alias("part"))
    found = dealt.join(spread, ["hash", "part"])
    words = told.select("row", "w")
    verified = found.join(words, "row").where(F.array_join(F.slice("w", F.col("p") + 1, k), " ") == F.col("run"))
    none = {f.name: F.lit(None).cast(f.dataType) for f in told.schema.fields if f.name in OWN}
    votes_only = verified.select("row", *[none[c].alias(c) for c in OWN], "p", *VOTE)
    empty = [F.lit(None).cast(votes_only.schema[c].dataType).alias(c) for c in ("p", *VOTE)]
    return told.select("row", *OWN, *empty).unionByName(votes_only)


def spans(voted: DataFrame, k: int = K, slack: int = 2, least: float = 0.8) -> DataFrame:
    """``row, label, start, end, coverage``: verified spans, in word numbers.

    Diagonals up to ``slack`` apart whose runs lie within ``slack`` words of
    each other are one span. It is kept if it covers at least ``least`` of the
    template's runs and its length differs from the template's by no more
    than the words that ``least`` lets go and the slack. Of spans that overlap
    (variants of one notice) those with the best coverage stay.
    """
    diagonals = (
        voted.where("p is not null")
        .groupBy("row", "template", "label", "t_words", "t_runs", (F.col("p") - F.col("q")).alias("diagonal"))
        .agg(F.min("p").alias("low"), F.max("p").alias("high"), F.collect_set("q").alias("q"))
    )
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    breaks = (
        (F.col("diagonal") - F.lag("diagonal").over(order) > slack)
        | (F.col("low") > F.lag("high").over(order) + k + slack)
        | (F.col("high") + k + slack < F.lag("low").over(order))
    )
    marked = diagonals.withColumn("new", F.when(breaks, 1).otherwise(0))
    merged = (
        marked.withColumn("part", F.sum("new").over(order))
        .groupBy("row", "template", "label", "t_words", "t_runs", "part")
        .agg(
            F.min("low").alias("start"),
            (F.max("high") + k).alias("end"),
            F.size(F.array_distinct(F.flatten(F.collect_list("q")))).alias("covered"),
        )
        .withColumn("coverage", F.col("covered") / F.col("t_runs"))
    )
    stray = F.abs(F.col("end") - F.col("start") - F.col("t_words"))
    good = merged.where((F.col("coverage") >= least) & (stray <= F.col("t_words") * (1 - least) + slack))
    along = Window.partitionBy("row").orderBy("start", "end", "template", "part")
    reached = F.max("end").over(along.rowsBetween(Window.unboundedPreceding, -1))
    placed = good.withColumn("fresh", F.when(F.col("start") < reached, 0).otherwise(1))
    placed = placed.withColumn("place", F.sum("fresh").over(along))
    best = F.max("coverage").over(Window.partitionBy("row", "place"))
    return placed.withColumn("best", best).where("coverage = best").select("row", "label", "start", "end", "coverage")


def scan(docs: DataFrame, templates: DataFrame | None = None, k: int = K, slack: int = 2, least: float = 0.8,
         base: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score, spans`` of every row.

    ``labels`` joins the base labels with those of verified spans; ``score``
    is 1 with a base phrase, else the best span's coverage, else 0. Null and
    empty texts have no words; very long ones are scanned whole. Of overlapping
    spans with equal coverage all stay. Repeated rows are scanned each; an empty
    table gives no rows. Extra columns do not matter.
    """
    templates = default_templates(docs.sparkSession) if templates is None else templates
    voted = stored(votes(docs, templates, k, base, id_col, text_col), "license-votes")
    per_row = spans(voted, k, slack, least).groupBy("row").agg(
        F.collect_set("label").alias("found"),
        F.max("coverage").alias("best"),
        F.array_sort(F.collect_list(F.struct("start", "end", "label", "coverage"))).alias("spans"),
    )
    no_labels = F.array().cast("array<string>")
    joined = voted.where("p is null").drop("p", "q", "template", "label", "t_words", "t_runs").join(per_row, "row", "left")
    listed = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    return joined.select(
        "doc_id",
        F.col("n").cast("long").alias("n_words"),
        F.col("n_base").cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"),
        F.col("last_word").cast("long").alias("last_word"),
        listed(F.col("base_labels")).alias("base_labels"),
        listed(F.concat("base_labels", F.coalesce("found", no_labels))).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
        "spans",
    )
