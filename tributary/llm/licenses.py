"""Licence scan with a positional rare-token index, in DataFrame functions only.

Null and empty texts have no words, no places and empty labels, and score 0. Repeated rows of one doc_id each give a row. An empty
table gives an empty result. Only doc_id and text are read. Texts are scanned whole.
"""

from __future__ import annotations

from math import log

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import written

#: Phrases whose places are counted, and the labels they give.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Label, words of a licence or its notice, and the phrase that must stand in them. Texts of licences are public.
TEMPLATES = [
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "person obtaining"),
    ("mit", "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so", "software without restriction"),
    ("apache", "licensed under the apache license version 2 0", "apache license"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", "apache license"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied", "applicable law"),
    ("gpl", "this work is licensed under the gnu general public license version 3", "general public license"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license", "general public license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "general public license"),
    ("lgpl", "licensed under the gnu lesser general public license version 3", "lesser general public license"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation", "lesser general public license"),
    ("agpl", "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation", "affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "binary forms"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", "above copyright notice"),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", "promote products derived"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", "without fee"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("epl", "made available under the terms of the eclipse public license", "eclipse public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software"),
    ("zlib", "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely", "commercial applications"),
    ("cc-by", "licensed under cc by 4 0", "cc by 4"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc0", "dedicated to the public domain under cc0 1 0", "cc0 1 0"),
    ("proprietary", "all rights reserved", "all rights reserved"),
]

#: Words too common to have postings; no mandatory phrase has any.
COMMON = {"the", "of", "to", "a", "in", "is", "and", "or", "it", "that", "for", "this", "are", "with", "can", "any", "you", "under", "as", "on", "be", "an", "do", "so", "not", "nor", "may", "its"}

#: Of the text before A-Z is put in lower case, what the words are: everything but ASCII that is neither a letter nor a digit.
WORD = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"

_UPPER = "".join(map(chr, range(65, 91)))


def postings() -> list[tuple[str, int, int, bool]]:
    """(word, template, position, mandatory) of every word of the templates that isn't common."""
    out = []
    for n, (_, notice, phrase) in enumerate(TEMPLATES):
        words, key = notice.split(), phrase.split()
        at = next(i for i in range(len(words)) if words[i : i + len(key)] == key)
        out += [(w, n, i, at <= i < at + len(key)) for i, w in enumerate(words) if w not in COMMON]
    return out


def found(documents: DataFrame) -> DataFrame:
    """(row, doc_id, n_words, hits): hits has position, word and the two next words of each word that the templates have."""
    vocabulary = sorted({p[0] for p in postings()})
    words = documents.select("doc_id", F.regexp_extract_all(F.translate(F.coalesce("text", F.lit("")), _UPPER, _UPPER.lower()), F.lit(WORD), F.lit(0)).alias("words"))
    hit = lambda w, i: F.when(w.isin(vocabulary), F.struct(i.alias("at"), w.alias("word"), F.get("words", i + 1).alias("next"), F.get("words", i + 2).alias("third")))
    return words.select("doc_id", F.size("words").cast("long").alias("n_words"), F.filter(F.transform("words", hit), lambda x: x.isNotNull()).alias("hits"))


def base_places(hits) -> F.Column:
    """(at, label) of each place where a phrase stands."""
    label = lambda x: F.coalesce(*[
        F.when((x["word"] == p[0]) & (x["next"] == p[1]) & ((x["third"] == p[2]) if len(p) > 2 else F.lit(True)), F.lit(name)) for p, name in ((k.split(), v) for k, v in PHRASES.items())
    ])
    return F.filter(F.transform(hits, lambda x: F.struct(x["at"].alias("at"), label(x).alias("label"))), lambda y: y["label"].isNotNull())


def scanned(documents: DataFrame, coverage: float = 0.6) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) for each row of documents.

    The frequency of the templates' words is taken over all documents. Of each template's mandatory phrase, the word with the highest
    IDF is looked up in every document; wherever it stands gives a place where the template would begin, and at each such place all
    its postings are intersected with the document by relative position. The template's label is given if the mandatory phrase is
    there and the words in their places have `coverage` of the template's IDF. Since a phrase has to be there whole, no place is
    missed for beginning at one of its words. score is the highest coverage, 1 for a base phrase.
    """
    rows = written(found(documents).withColumn("row", F.monotonically_increasing_id()), "hits")
    spark = rows.sparkSession
    n = rows.count()
    df = {r["w"]: r["n"] for r in rows.select(F.explode(F.array_distinct(F.transform("hits", lambda x: x["word"]))).alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()}
    idf = {p[0]: log((n + 2) / (df.get(p[0], 0) + 1)) for p in postings()}
    total: dict[int, float] = {}
    for w, t, _, _ in postings():
        total[t] = total.get(t, 0.0) + idf[w]
    musts = {t: sum(p[3] for p in postings() if p[1] == t) for t in total}
    rarest = {t: min((-idf[w], at) for w, n, at, must in postings() if n == t and must)[1] for t in total}
    row = lambda w, t, at, must: F.struct(F.lit(w).alias("word"), F.lit(t).alias("template"), F.lit(at).alias("pos"), F.lit(must).alias("must"), F.lit(at == rarest[t]).alias("is_rarest"), F.lit(idf[w]).alias("idf"), F.lit(total[t]).alias("total"), F.lit(musts[t]).alias("musts"), F.lit(TEMPLATES[t][0]).alias("label"))
    table = F.broadcast(spark.range(1).select(F.inline(F.array(*[row(*p) for p in postings()]))))  # as many rows as the templates have words
    each = rows.select("row", F.explode("hits").alias("hit")).select("row", F.col("hit.at").alias("at"), F.col("hit.word").alias("word"))
    posted = each.join(table, "word").withColumn("start", F.col("at") - F.col("pos"))
    begins = posted.filter("is_rarest").select("row", "template", "start").distinct()
    there = posted.select("row", "template", "start", "pos", "must", "idf", "total", "musts", "label").join(begins, ["row", "template", "start"])
    met = there.groupBy("row", "template", "start").agg(F.count_if("must").alias("got"), F.first("musts").alias("musts"), (F.sum("idf") / F.first("total")).alias("share"), F.first("label").alias("label"))
    more = met.filter((F.col("got") >= F.col("musts")) & (F.col("share") >= coverage)).groupBy("row").agg(F.collect_set("label").alias("more"), F.max("share").alias("share"))
    base = rows.select("row", "doc_id", "n_words", base_places("hits").alias("base"))
    labels = F.array_distinct(F.transform("base", lambda x: x["label"]))
    out = base.join(more, "row", "left").withColumn("own", labels)
    own, every = F.array_sort("own"), F.array_sort(F.array_union("own", F.coalesce("more", F.array().cast("array<string>"))))
    return out.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(F.transform("base", lambda x: x["at"])).cast("long").alias("first_word"), F.array_max(F.transform("base", lambda x: x["at"])).cast("long").alias("last_word"),
        F.array_join(own, ",").alias("base_labels"), F.array_join(every, ",").alias("labels"), F.when(F.size("base") > 0, 1.0).otherwise(F.least(F.lit(1.0), F.coalesce("share", F.lit(0.0)))).alias("score"),
    )


def op10_licenses(spark, sf_dir: str) -> DataFrame:
    """Whole documents table: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    return scanned(spark.read.parquet(f"{sf_dir}/documents.parquet"))
