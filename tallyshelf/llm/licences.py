"""Licence scan by sentence rules: known sentences become identifiers, rules are ordered identifier sequences.

All of it is built-in column functions on one row: no shuffle, no join and no Python on the executors.

A sentence begins and ends at a line break, at `.`, `!`, `?` or `;` before white space, or at an end of the text, and
is compared in lower case with every run of other characters than letters and digits as one space. Inside it there
may be such stops (`v. 2.0`) and single line breaks, with a comment mark or indent after them, as hard-wrapped texts
and source files have them, but no blank line. Where several known sentences begin at one place the longest counts.
A notice may open with its subject (`This project is ...`). A sentence that is known becomes its number, all others
are dropped, and a rule holds where its numbers stand in a row in what is left. A rule that is part of a longer rule
which also holds is not reported.

Null or empty text has no sentences and no licences. Repeated rows and ids each give a row. Other columns
are not read. Texts of any length are scanned whole.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyshelf.llm.common import id_and_text

# Sentences of public licences and notices, and the order in which a licence has them.
SENTENCES: dict[int, str] = {
    1: "this work is licensed under the gnu general public license version 3",
    2: "licensed under cc by nc 4 0",
    3: "released under the mit license",
    4: "licensed under the apache license version 2 0",
    5: "licensed under the apache license version 2 0 the license",
    6: "you may not use this file except in compliance with the license",
    7: "you may obtain a copy of the license at",
    8: "unless required by applicable law or agreed to in writing software distributed under the license is "
       "distributed on an as is basis without warranties or conditions of any kind either express or implied",
    9: "see the license for the specific language governing permissions and limitations under the license",
    10: "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files the software to deal in the software without restriction including "
        "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
        "copies of the software and to permit persons to whom the software is furnished to do so subject to "
        "the following conditions",
    11: "the above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the software",
    12: "the software is provided as is without warranty of any kind express or implied including but not "
        "limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    13: "redistribution and use in source and binary forms with or without modification are permitted provided "
        "that the following conditions are met",
    14: "redistributions of source code must retain the above copyright notice this list of conditions and the "
        "following disclaimer",
    15: "redistributions in binary form must reproduce the above copyright notice this list of conditions and "
        "the following disclaimer in the documentation and or other materials provided with the distribution",
    16: "neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission",
    17: "this program is free software you can redistribute it and or modify it under the terms of the gnu "
        "general public license as published by the free software foundation either version 3 of the license "
        "or at your option any later version",
    18: "this program is free software you can redistribute it and or modify it under the terms of the gnu "
        "general public license as published by the free software foundation either version 2 of the license "
        "or at your option any later version",
    19: "this program is distributed in the hope that it will be useful but without any warranty without even "
        "the implied warranty of merchantability or fitness for a particular purpose",
    20: "permission to use copy modify and or distribute this software for any purpose with or without fee is "
        "hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    21: "this work is licensed under a creative commons attribution 4 0 international license",
    22: "this source code form is subject to the terms of the mozilla public license v 2 0",
    23: "spdx license identifier mit",
    24: "spdx license identifier apache 2 0",
    25: "spdx license identifier gpl 3 0 or later",
    26: "spdx license identifier bsd 3 clause",
    27: "licensed under the mit license",
}
RULES: list[tuple[str, tuple[int, ...]]] = [
    ("apache-2.0", (5, 6, 7, 8, 9)),
    ("apache-2.0", (5, 6)),
    ("apache-2.0", (4,)),
    ("apache-2.0", (24,)),
    ("bsd-3-clause", (13, 14, 15, 16)),
    ("bsd-3-clause", (26,)),
    ("bsd-2-clause", (13, 14, 15)),
    ("cc-by-4.0", (21,)),
    ("cc-by-nc-4.0", (2,)),
    ("gpl-2.0-or-later", (18, 19)),
    ("gpl-3.0", (1,)),
    ("gpl-3.0-or-later", (17, 19)),
    ("gpl-3.0-or-later", (25,)),
    ("isc", (20,)),
    ("mit", (10, 11, 12)),
    ("mit", (3,)),
    ("mit", (27,)),
    ("mit", (23,)),
    ("mpl-2.0", (22,)),
]
#: Each known sentence has one of these, so a text without any has no known sentence.
ANCHORS = ("licen", "permi", "redistrib", "copyright", "warrant")

# How the SQL cuts, which has one-line sentences only.
SENTENCE_BREAK = r"[\n\r]+|[.!?;]+[ \t\n\r]+"
NO_WORD = r"[^\p{L}\p{N}]+"

LINE, STOP = "\u0001", "\u0002"
# What may stand between two words of a sentence: at most one line break, and a stop before it.
BETWEEN = f"(?: ?{STOP} ?{LINE} ?| ?[{LINE}{STOP}] ?| )"
SUBJECT = ("this", "(?:project|software|work|code|source code|file|program|library|package|module|repository)", "is")


def normalised(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(sentence, NO_WORD, " "))


def sentence_numbers(text: Column, sentences: Mapping[int, str] = SENTENCES, anchors: Sequence[str] = ANCHORS) -> Column:
    """The numbers of a text's known sentences in text order, as an array of int."""
    known = F.create_map(*[F.lit(x) for number, words in sentences.items() for x in (words, number)])
    longest = sorted(sentences.values(), key=len, reverse=True)
    subject = "".join(word.replace(" ", BETWEEN) + BETWEEN for word in SUBJECT)
    bare = "|".join(BETWEEN.join(words.split()) for words in longest)
    pattern = f"(?<=[{LINE}{STOP}] ?)(?:(?:{bare})|{subject}(?:{bare}))(?= ?[{LINE}{STOP}])"
    low = F.lower(text)
    may_have = F.lit(False)
    for anchor in anchors:
        may_have = may_have | low.contains(anchor)
    marked = F.regexp_replace(F.translate(low, LINE + STOP, "  "), r"[.!?;]+(?=[ \t\n\r])", STOP)
    marked = F.regexp_replace(marked, r"\r\n?|\n", LINE)
    marked = F.concat(F.lit(LINE), F.regexp_replace(marked, rf"[^\p{{L}}\p{{N}}{LINE}{STOP}]+", " "), F.lit(LINE))
    opening = f"^{' '.join(SUBJECT)} "

    def number(found: Column) -> Column:
        words = normalised(found)
        whole = F.try_element_at(known, words)
        return F.coalesce(whole, F.try_element_at(known, F.regexp_replace(words, opening, "")))

    numbers = F.transform(F.regexp_extract_all(marked, F.lit(pattern), F.lit(0)), number)
    return F.when(may_have, F.filter(numbers, lambda n: n.isNotNull())).otherwise(F.array().cast("array<int>"))


def _within(part: tuple[int, ...], whole: tuple[int, ...]) -> bool:
    return len(part) < len(whole) and any(whole[k : k + len(part)] == part for k in range(len(whole)))


def scan_licences(
    docs: DataFrame,
    sentences: Mapping[int, str] = SENTENCES,
    rules: Sequence[tuple[str, tuple[int, ...]]] = RULES,
    anchors: Sequence[str] = ANCHORS,
) -> DataFrame:
    """doc_id, sentence_ids array<int>, rule_ids array<int> (places in `rules`), licences array<string>, sorted."""
    found = id_and_text(docs).select(
        "doc_id", sentence_numbers(F.col("text"), sentences, anchors).alias("sentence_ids")
    )
    line = F.concat(F.lit(","), F.array_join(F.col("sentence_ids").cast("array<string>"), ","), F.lit(","))
    found = found.withColumn("_line", line)
    holds = [F.col("_line").contains("," + ",".join(map(str, seq)) + ",") for _, seq in rules]
    kept = []
    for k, (_, seq) in enumerate(rules):
        ok = holds[k]
        for j, (_, longer) in enumerate(rules):
            if _within(seq, longer):
                ok = ok & ~holds[j]
        kept.append(F.when(ok, F.lit(k)))
    names = F.array(*[F.lit(name) for name, _ in rules])
    rule_ids = F.array_compact(F.array(*kept))
    return found.withColumn("rule_ids", rule_ids).select(
        "doc_id",
        "sentence_ids",
        "rule_ids",
        F.array_sort(F.array_distinct(F.transform("rule_ids", lambda k: F.element_at(names, k + 1)))).alias("licences"),
    )


def q_licences(spark, sf_dir: str) -> DataFrame:
    from tallyshelf.llm.common import table

    found = scan_licences(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.size("sentence_ids").cast("long").alias("n_sentences"),
        F.array_join(F.col("sentence_ids").cast("array<string>"), ",").alias("sentence_ids"),
        F.array_join("licences", ",").alias("licences"),
    )


def licences_sql() -> str:
    """The same in DuckDB's SQL, by joins of rows and not by functions of arrays."""
    known = ", ".join(f"({n}, '{s}')" for n, s in SENTENCES.items())
    rules = ", ".join(f"({k}, '{name}', ',{','.join(map(str, seq))},')" for k, (name, seq) in enumerate(RULES))
    covers = [(k, j) for k, (_, a) in enumerate(RULES) for j, (_, b) in enumerate(RULES) if _within(a, b)]
    return f"""
    with known(number, words) as (values {known}),
    rules(k, name, seq) as (values {rules}),
    covers(k, j) as (values {", ".join(map(str, covers))}),
    cut as (select doc_id, unnest(regexp_split_to_array(lower(coalesce(text, '')), '{SENTENCE_BREAK}')) as s,
            generate_subscripts(regexp_split_to_array(lower(coalesce(text, '')), '{SENTENCE_BREAK}'), 1) as place
            from documents),
    hits as (select doc_id, place, number from cut
             join known on trim(regexp_replace(s, '{NO_WORD}', ' ', 'g')) = words),
    lines as (select doc_id, count(*) as n_sentences, string_agg(number::varchar, ',' order by place) as sentence_ids
              from hits group by doc_id),
    held as (select doc_id, k, name from lines join rules on contains(',' || sentence_ids || ',', seq)),
    best as (select h.doc_id, h.name from held h where not exists
             (select 1 from covers c join held g on g.k = c.j where c.k = h.k and g.doc_id = h.doc_id)),
    named as (select doc_id, string_agg(distinct name, ',' order by name) as licences from best group by doc_id)
    select d.doc_id, coalesce(n_sentences, 0) as n_sentences, coalesce(sentence_ids, '') as sentence_ids,
           coalesce(licences, '') as licences
    from documents d left join lines using (doc_id) left join named using (doc_id)
    """
