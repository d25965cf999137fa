"""License scans by diagonal voting over word k-grams."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bazaarlake.llm.common import NOT_WORD, let, lower_ascii, split_words

GRAM = 3
# Diagonals at most this many words apart belong together: a word put in or left out.
NEIGHBOURS = 2
# Share of a template's k-grams that has to be found.
LEAST_SHARE = 0.75

# Phrases that name a license by themselves.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Notices whose wording may vary a little.
NOTICES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "licensed under the apache license version 2 0": "apache-2",
    "you may not use this file except in compliance with the license": "apache-2",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "this work is licensed under the gnu general public license version 3": "gpl-3",
    "this work is licensed under the gnu general public license version 2": "gpl-2",
    "this program is free software you can redistribute it and or modify": "gpl",
    "licensed under the gnu lesser general public license": "lgpl",
    "licensed under the mozilla public license version 2 0": "mpl-2",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "licensed under a creative commons attribution 4 0 international license": "cc-by-4",
    "licensed under a creative commons attribution sharealike 4 0 international license": "cc-by-sa-4",
}
# The bodies of licenses short enough to stand in a file as a whole.
BODIES = {
    """Permission is hereby granted, free of charge, to any person obtaining a copy of this software
    and associated documentation files (the "Software"), to deal in the Software without
    restriction, including without limitation the rights to use, copy, modify, merge, publish,
    distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
    Software is furnished to do so, subject to the following conditions: The above copyright notice
    and this permission notice shall be included in all copies or substantial portions of the
    Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
    INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE
    AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
    DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
    OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""": "mit",
    """Permission to use, copy, modify, and/or distribute this software for any purpose with or
    without fee is hereby granted, provided that the above copyright notice and this permission
    notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL
    WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
    FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
    CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
    WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN
    CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""": "isc",
    """Redistribution and use in source and binary forms, with or without modification, are permitted
    provided that the following conditions are met: 1. Redistributions of source code must retain
    the above copyright notice, this list of conditions and the following disclaimer. 2.
    Redistributions in binary form must reproduce the above copyright notice, this list of
    conditions and the following disclaimer in the documentation and/or other materials provided
    with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS
    IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES
    OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.""": "bsd-2",
    """Redistribution and use in source and binary forms, with or without modification, are permitted
    provided that the following conditions are met: 1. Redistributions of source code must retain
    the above copyright notice, this list of conditions and the following disclaimer. 2.
    Redistributions in binary form must reproduce the above copyright notice, this list of
    conditions and the following disclaimer in the documentation and/or other materials provided
    with the distribution. 3. Neither the name of the copyright holder nor the names of its
    contributors may be used to endorse or promote products derived from this software without
    specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND
    CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
    IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.""": "bsd-3",
    """This software is provided 'as-is', without any express or implied warranty. In no event will
    the authors be held liable for any damages arising from the use of this software. Permission is
    granted to anyone to use this software for any purpose, including commercial applications, and
    to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of
    this software must not be misrepresented; you must not claim that you wrote the original
    software. If you use this software in a product, an acknowledgment in the product documentation
    would be appreciated but is not required. 2. Altered source versions must be plainly marked as
    such, and must not be misrepresented as being the original software. 3. This notice may not be
    removed or altered from any source distribution.""": "zlib",
    """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
    except in compliance with the License. You may obtain a copy of the License at
    http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in
    writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
    WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
    specific language governing permissions and limitations under the License.""": "apache-2",
    """This is free and unencumbered software released into the public domain. Anyone is free to
    copy, modify, publish, use, compile, sell, or distribute this software, either in source code
    form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.
    In jurisdictions that recognize copyright laws, the author or authors of this software dedicate
    any and all copyright interest in the software to the public domain. We make this dedication for
    the benefit of the public at large and to the detriment of our heirs and successors.""": "unlicense",
}


def plain(text: str) -> str:
    """The words of a template as texts are read, one space between."""
    return " ".join(re.findall("[a-z0-9]+", text.lower()))


def template_grams(spark: SparkSession, phrases: dict[str, str], notices: dict[str, str]) -> DataFrame:
    """One row per word k-gram of a template: its text, place and the template's length."""
    rows = []
    listed = [(p, label, True) for p, label in phrases.items()]
    listed += [(plain(p), label, False) for p, label in notices.items()]
    for number, (phrase, label, base) in enumerate(listed):
        words = phrase.split()
        grams = len(words) - GRAM + 1
        if grams < 1:
            raise ValueError(f"a template needs {GRAM} words: {phrase}")
        for place in range(grams):
            rows.append((" ".join(words[place : place + GRAM]), number, label, base, place, grams))
    # The empty gram stands for the text itself, so every text has a row whatever it holds.
    rows.append(("", -1, "", False, 0, 1))
    schema = "gram string, template int, label string, base boolean, place int, grams int"
    table = spark.createDataFrame(rows, schema).repartition(1)
    return table.withColumn("gram_hash", F.xxhash64("gram"))


def _grams(words: Column) -> Column:
    """The empty gram with the word count as its place, then every k-gram with its place."""
    inner = F.transform(
        F.sequence(F.lit(0), F.size(words) - GRAM),
        lambda i: F.struct(
            i.alias("at"), F.concat_ws(" ", *[F.get(words, i + j) for j in range(GRAM)]).alias("gram")
        ),
    )
    whole = F.array(F.struct(F.size(words).alias("at"), F.lit("").alias("gram")))
    return F.when(F.size(words) < GRAM, whole).otherwise(F.concat(whole, inner))


def scan(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    phrases: dict[str, str] = BASE_PHRASES,
    notices: dict[str, str] = {**NOTICES, **BODIES},
) -> DataFrame:
    """Per row: word count, places of base phrases, labels and the best share of a template.

    All rolling k-grams of the texts are hashed and joined with the template positions (a fixed
    table of about a thousand rows, which is broadcast; the texts of the grams are compared too).
    A hit votes for its diagonal, text place minus template place. Diagonals close to each other
    are merged; a merged group is a span, verified by the share of the template's k-grams found
    in it. A base phrase stands at a place when its diagonal has all votes. Only hits leave a
    task: one row per text and the few k-grams that templates hold.

    Null and empty texts have no words and no labels. Each row of ``docs`` gives one row, repeated
    rows and null keys too. Output: the key, ``n_words``, ``n_base``, ``first_word``,
    ``last_word``, ``base_labels``, ``labels``, ``score`` and ``spans`` (label, first and last
    word, share).
    """
    spark = docs.sparkSession
    templates = template_grams(spark, phrases, notices)
    words = split_words(lower_ascii(F.col(text)), NOT_WORD)
    rolled = (
        docs.select(F.monotonically_increasing_id().alias("_row"), key, text)
        # Never empty; a plain explode has its input computed once more by a filter for empty lists.
        .select("_row", key, F.explode_outer(let(words, _grams)).alias("_g"))
        .select("_row", key, F.col("_g.at").alias("at"), F.col("_g.gram").alias("gram"))
        .withColumn("gram_hash", F.xxhash64("gram"))
    )
    hits = rolled.join(F.broadcast(templates), ["gram_hash", "gram"])
    diagonals = hits.groupBy(
        "_row", key, "template", "label", "base", "grams", (F.col("at") - F.col("place")).alias("diagonal")
    ).agg(
        F.count("*").alias("votes"),
        F.collect_set("place").alias("places"),
        F.min("at").alias("first"),
        (F.max("at") + GRAM - 1).alias("last"),
    )
    along = Window.partitionBy("_row", "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > NEIGHBOURS, F.lit(True))
    grouped = diagonals.withColumn("_new", apart.cast("int")).withColumn(
        "_group", F.sum("_new").over(along)
    )
    spans = grouped.groupBy("_row", key, "template", "label", "base", "grams", "_group").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("found"),
        F.count_if(F.col("votes") == F.col("grams")).alias("exact"),
        F.min(F.when(F.col("votes") == F.col("grams"), F.col("diagonal"))).alias("exact_first"),
        F.max(F.when(F.col("votes") == F.col("grams"), F.col("diagonal"))).alias("exact_last"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
    )
    spans = spans.withColumn("share", F.col("found") / F.col("grams"))
    # Templates that claim the same words compete: the fullest one has them.
    earlier = Window.partitionBy("_row").orderBy("first", "last", "template")
    reach = F.max("last").over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn(
        "_clash", F.sum(F.coalesce(F.col("first") > reach, F.lit(True)).cast("int")).over(earlier)
    ).withColumn("_fullest", F.max("share").over(Window.partitionBy("_row", "_clash")))
    is_base = F.col("base") & (F.col("exact") > 0)
    real = F.col("template") >= 0
    full = (F.col("share") >= LEAST_SHARE) & (F.col("share") == F.col("_fullest"))
    verified = real & F.when(F.col("base"), F.col("exact") > 0).otherwise(full)

    def labels(which: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(F.when(which, F.col("label")))), ",")

    return (
        spans.groupBy("_row", key)
        .agg(
            # The row of the whole text has the word count as its place.
            F.max(F.when(~real, F.col("first"))).cast("long").alias("n_words"),
            F.sum(F.when(is_base, F.col("exact")).otherwise(0)).cast("long").alias("n_base"),
            F.min(F.when(is_base, F.col("exact_first"))).cast("long").alias("first_word"),
            F.max(F.when(is_base, F.col("exact_last"))).cast("long").alias("last_word"),
            labels(is_base).alias("base_labels"),
            labels(verified).alias("labels"),
            F.coalesce(F.max(F.when(real, F.col("share"))), F.lit(0.0)).alias("score"),
            F.array_sort(
                F.collect_list(F.when(verified, F.struct("label", "first", "last", "share")))
            ).alias("spans"),
        )
        .drop("_row")
    )
