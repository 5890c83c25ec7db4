"""Licence recognition by sentence rules, with Spark's own functions only.

A text is cut into sentences, each is normalised and mapped to the identifier of a known licence sentence. Ordered rules
then look for sequences of identifiers; a rule takes the sentences it matched, so that a longer licence (rules come first
that say more) is not also reported as the shorter one that it contains. Everything stays in the row of the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Identifier, and the sentence as licences word it, normalised (small letters, digits, single spaces).
SENTENCES = [
    ("apache2-under", "licensed under the apache license version 2 0"),
    ("apache2-the-license", "licensed under the apache license version 2 0 the license"),
    ("apache2-comply", "you may not use this file except in compliance with the license"),
    ("apache2-copy", "you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("as-is-unless", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("mit-under", "released under the mit license"),
    ("mit-licensed", "licensed under the mit license"),
    ("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"),
    ("mit-notice", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("gpl3-work", "this work is licensed under the gnu general public license version 3"),
    ("gpl3-later", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl2-later", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("gpl-useful", "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("bsd-grant", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd-source", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd-binary", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd-names", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("cc-by-nc-4", "licensed under cc by nc 4 0"),
    ("cc-by-4", "licensed under cc by 4 0"),
    ("cc-by-sa-4", "licensed under cc by sa 4 0"),
    ("cc0-1", "released under cc0 1 0"),
]

#: Licence, and the identifiers that follow each other in a text under it. Earlier rules say more and are tried first.
RULES = [
    ("Apache-2.0", ["apache2-the-license", "apache2-comply", "apache2-copy", "as-is-unless"]),
    ("Apache-2.0", ["apache2-the-license", "apache2-comply", "apache2-copy"]),
    ("Apache-2.0", ["apache2-the-license"]),
    ("Apache-2.0", ["apache2-under"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("MIT", ["mit-grant", "mit-notice"]),
    ("MIT", ["mit-under"]),
    ("MIT", ["mit-licensed"]),
    ("GPL-3.0-or-later", ["gpl3-later", "gpl-useful"]),
    ("GPL-3.0-or-later", ["gpl3-later"]),
    ("GPL-2.0-or-later", ["gpl2-later", "gpl-useful"]),
    ("GPL-2.0-or-later", ["gpl2-later"]),
    ("GPL-3.0-only", ["gpl3-work"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4"]),
    ("CC-BY-4.0", ["cc-by-4"]),
    ("CC0-1.0", ["cc0-1"]),
]

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Ends of sentences: where lines end sentences too, and where a sentence may run over several lines.
BY_LINE, BY_MARK = r"[.!?:;]+([ \t\r\n]+|$)|[\r\n]+", r"[.!?:;]+([ \t\r\n]+|$)|[\r\n][ \t]*[\r\n]+"


def sentence_ids(text: Column, ends: str, sentences: list[tuple[str, str]]) -> Column:
    """The identifiers of the known sentences of a text in order, each in angle brackets."""
    known, ids = [s for _, s in sentences], {s: f"<{i}>" for i, s in sentences}
    plain = F.translate(F.coalesce(text, F.lit("")), CAPITALS, SMALL)
    units = F.transform(F.split(plain, ends), lambda s: F.trim(F.regexp_replace(s, "[^a-z0-9]+", " ")))
    lookup = F.map_from_arrays(F.array(*map(F.lit, known)), F.array(*[F.lit(ids[s]) for s in known]))
    return F.array_join(F.transform(F.filter(units, lambda s: s.isin(known)), lambda s: F.element_at(lookup, s)), "")


def apply_rules(ids: Column, rules: list[tuple[str, list[str]]]) -> Column:
    """The sequence with each match of a rule replaced by its licence in square brackets."""
    for licence, sequence in rules:
        ids = F.replace(ids, F.lit("".join(f"<{i}>" for i in sequence)), F.lit(f"[{licence}]"))
    return ids


def recognise_licenses(
    docs: DataFrame, text_column: str = "text", sentences: list[tuple[str, str]] = SENTENCES, rules: list[tuple[str, list[str]]] = RULES
) -> DataFrame:
    """The rows of ``docs`` with sentence_ids, licenses and unmatched_ids (strings).

    sentence_ids: the known sentences in order, by lines if that finds any and else over line ends; licenses: the sorted
    licences of the rules that match, joined by commas; unmatched_ids: known sentences that no rule took.

    Null or empty text: three empty strings. Rows are judged alone, so repeated rows, other columns and an empty table are
    kept as they are; columns named like the results are replaced.
    """
    by_line, by_mark = (sentence_ids(F.col(text_column), ends, sentences) for ends in (BY_LINE, BY_MARK))
    taken = docs.drop("sentence_ids", "licenses", "unmatched_ids").withColumns({"_by_line": by_line, "_by_mark": by_mark})
    taken = taken.withColumns({"_line_rules": apply_rules(F.col("_by_line"), rules), "_mark_rules": apply_rules(F.col("_by_mark"), rules)})
    both = F.concat("_line_rules", "_mark_rules")
    names = F.array_sort(F.array_distinct(F.regexp_extract_all(both, F.lit(r"\[([^\]]+)\]"), 1)))
    best = F.when(F.col("_by_line") != "", F.col("_line_rules")).otherwise(F.col("_mark_rules"))
    return taken.withColumns(
        {
            "sentence_ids": F.when(F.col("_by_line") != "", F.col("_by_line")).otherwise(F.col("_by_mark")),
            "licenses": F.array_join(names, ","),
            "unmatched_ids": F.array_join(F.regexp_extract_all(best, F.lit("<([^>]+)>"), 1), ","),
        }
    ).drop("_by_line", "_by_mark", "_line_rules", "_mark_rules")
