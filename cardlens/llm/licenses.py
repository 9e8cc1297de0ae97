"""License scan by diagonal voting.

Every rolling k-gram of words of every document is hashed; hashes meet the positions of
the license templates in a Spark join.  A hit votes for the diagonal (document place
minus template place).  Votes are summed per (document, template, diagonal), neighbouring
diagonals (a word put in or left out shifts to the next) are merged to spans, and a span is
kept when it covers enough of its template.  Short phrases must lie on one diagonal whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import textkernel as K
from .common import bit_table, documents, in_tasks, write_table

K_GRAM = 3
DRIFT = 6              # diagonals at most this far apart are one span
MIN_COVER = 0.5        # least share of a template's k-grams in a span
FILTER_LOG2 = 24

#: fixed values: phrases and the labels they stand for
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: fixed values: wording of widespread license notices
NOTICES = {
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
           "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
           "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
           "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
           "notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "apache-2": "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
                "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
                "distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
                "either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
           "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
           "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
           "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
           "provided that the above copyright notice and this permission notice appear in all copies.",
    "gpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
           "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "cc-by-nc": "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License",
    "cc-by": "This work is licensed under the Creative Commons Attribution 4.0 International License",
}


def _word_hashes(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    return K.words(data, np.array([0, len(data)]), K.ALNUM).hashes


def _template_grams(spark: SparkSession, phrases: dict[str, str], notices: dict[str, str], k: int) -> DataFrame:
    """(hash, template, label, phrase, place, grams) of all templates; a parameter's size."""
    rows = []
    for i, (text, label, phrase) in enumerate([*((t, x, True) for t, x in phrases.items()), *((t, x, False) for x, t in notices.items())]):
        w = _word_hashes(text)
        if len(w) < k:
            raise ValueError(f"a template needs at least {k} words: {text!r}")
        g = K.grams(w, range(k)).view(np.int64).tolist()
        rows += [(h, i, label, phrase, place, len(g)) for place, h in enumerate(g)]
    return spark.createDataFrame(rows, "hash long, template int, label string, phrase boolean, place long, grams long")


def _hits(filter_, k: int):
    """One row per document: its id, number of words, and the k-grams that the filter lets through."""
    def run(batches):
        for batch in batches:
            for lo, hi, data, ptr in K.blocks(batch.column(1)):
                w = K.words(data, ptr, K.ALNUM)
                g = K.grams(w.hashes, range(k))
                at = np.flatnonzero(K.has_bit(filter_.value, g, FILTER_LOG2))
                doc = np.searchsorted(w.ptr, at, "right") - 1
                inside = at + k <= w.ptr[doc + 1]
                at, doc = at[inside], doc[inside]
                cut = np.searchsorted(doc, np.arange(hi - lo + 1))
                lists = lambda v: pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(v, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo).cast(pa.int64()), pa.array(np.diff(w.ptr), pa.int64()),
                     lists(g[at].view(np.int64)), lists(at - w.ptr[doc])], ["doc_id", "n_words", "hashes", "places"])
    return run


def license_scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES, k: int = K_GRAM,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base (places of all phrases), first_word and
    last_word (smallest and largest start of a place, from 0; else null), base_labels, labels (with
    those of notices; distinct, sorted, comma-joined), score (1 with a phrase, else the best span's
    covered share, else 0) and spans (of notices: label, first and last word, cover).

    Words are lower-cased runs of digits, letters and non-ASCII characters.  Null and empty texts
    have no words and no labels (empty strings, score 0); a null id stays null; repeated
    rows are scanned each; an empty table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    templates = write_table(_template_grams(spark, phrases, notices, k), "templates")
    filter_ = spark.sparkContext.broadcast(bit_table(templates, "hash", FILTER_LOG2))
    rows = write_table(in_tasks(documents(docs, id_col, text_col), _hits(filter_, k),
                                "doc_id long, n_words long, hashes array<long>, places array<long>")
                       .withColumn("row", F.monotonically_increasing_id()), "license_hits")
    hits = (rows.where(F.size("hashes") > 0).select("row", F.explode(F.arrays_zip("hashes", "places")).alias("x"))
            .select("row", F.col("x.hashes").alias("hash"), F.col("x.places").alias("at")).join(templates, "hash"))
    votes = (hits.groupBy("row", "template", "label", "phrase", "grams", (F.col("at") - F.col("place")).alias("diagonal"))
             .agg(F.count(F.lit(1)).alias("votes"), F.min("place").alias("low"), F.max("place").alias("high")))
    # a phrase stands where all its k-grams voted for one diagonal, which is its first word
    base = (votes.where("phrase and votes = grams").groupBy("row")
            .agg(F.count(F.lit(1)).alias("n_base"), F.min("diagonal").alias("first_word"), F.max("diagonal").alias("last_word"),
                 F.collect_set("label").alias("base_labels")))
    by_place = Window.partitionBy("row", "template").orderBy("diagonal")
    spread = votes.where("not phrase").withColumn("new", (F.col("diagonal") - F.lag("diagonal").over(by_place) <= DRIFT).cast("int"))
    spread = spread.withColumn("span", F.sum(1 - F.coalesce("new", F.lit(0))).over(by_place))
    # a template place counts once a span, however many diagonals voted for it
    places = (hits.where("not phrase").withColumn("diagonal", F.col("at") - F.col("place"))
              .join(spread.select("row", "template", "diagonal", "span"), ["row", "template", "diagonal"])
              .groupBy("row", "template", "label", "grams", "span", "place").agg(F.min("at").alias("a"), F.max("at").alias("b")))
    spans = (places.groupBy("row", "template", "label", "grams", "span")
             .agg((F.count(F.lit(1)) / F.col("grams")).alias("cover"), F.min("a").alias("first"), (F.max("b") + (k - 1)).alias("last"))
             .where(F.col("cover") >= MIN_COVER))
    found = spans.groupBy("row").agg(F.max("cover").alias("cover"), F.collect_set("label").alias("more"),
                                     F.sort_array(F.collect_list(F.struct("label", "first", "last", "cover"))).alias("spans"))
    joined = rows.select("row", "doc_id", "n_words").join(base, "row", "left").join(found, "row", "left")
    none = F.array().cast("array<string>")
    text = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    own = F.coalesce("base_labels", none)
    return joined.select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        text(own).alias("base_labels"), text(F.concat(own, F.coalesce("more", none))).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("cover", F.lit(0.0))).alias("score"), "spans")
