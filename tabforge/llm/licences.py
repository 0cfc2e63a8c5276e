"""Licence recognition by sentence rules (operator 3).

1. Each whole text is split into sentences at blank lines (also of comment leaders), around lines
   that are only an SPDX tag or a title, and at . ! ? before white space; other line ends are
   white space, so wrapped notices stay in one piece.
2. A sentence is normalised: A-Z in lower case, "licence" as "license", everything but a-z and
   0-9 as single spaces.
3. Sentences become all identifiers whose patterns they match, by position, without those that lie
   inside the match of an earlier pattern; sentences that only speak of a license become
   ``unknown``; all others vanish, so a licence is found in one piece although prose surrounds it.
4. The sequence of identifiers is matched against ordered rules, longer ones first; a matched
   stretch is taken out, so that a sentence counts for one licence.

Everything is JVM expressions on one row: no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Sentences of public licences, as patterns on normalised sentences, in the order
# in which they are tried.
SENTENCES = [
    ("mit_grant", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit_notice", "the above copyright notice and this permission notice shall be included in all copies"),
    ("mit_warranty", "the software is provided as is without warranty of any kind"),
    ("bsd_head", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd_source", "redistributions of source code must retain the above copyright notice"),
    ("bsd_binary", "redistributions in binary form must reproduce the above copyright notice"),
    ("bsd_endorse", "neither the name of .* may be used to endorse or promote products"),
    ("bsd_warranty", "this software is provided by the copyright holders and contributors as is"),
    ("apache_comply", "you may not use this file except in compliance with the license"),
    ("apache_copy", "you may obtain a copy of the license at"),
    ("apache_warranty", "unless required by applicable law or agreed to in writing software"),
    ("apache2_ref", "apache license version 2( 0)?|apache 2 0 license|spdx license identifier apache 2 0"),
    ("gpl_free", "is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl_warranty", "is distributed in the hope that it will be useful but without any warranty"),
    ("gpl_copy", "you should have received a copy of the gnu general public license"),
    ("gpl3_later", "either version 3 of the license or at your option any later version|gpl version 3 or later|spdx license identifier gpl 3 0 or later"),
    ("agpl3_ref", "gnu affero general public license( as published by the free software foundation)? (version|v) ?3|spdx license identifier agpl 3 0"),
    ("lgpl3_ref", "gnu lesser general public license( as published by the free software foundation)? (version|v) ?3|spdx license identifier lgpl 3 0"),
    ("gpl3_ref", "gnu general public license( as published by the free software foundation)? (version|v) ?3|spdx license identifier gpl 3 0"),
    ("gpl2_ref", "gnu general public license( as published by the free software foundation)? (version|v) ?2|spdx license identifier gpl 2 0"),
    ("mpl2_ref", "mozilla public license (version |v )?2 0|spdx license identifier mpl 2 0"),
    ("cc_by_nc_sa", "cc by nc sa 4 0|creative commons attribution noncommercial sharealike 4 0"),
    ("cc_by_nc", "cc by nc 4 0|creative commons attribution noncommercial 4 0"),
    ("cc_by_sa", "cc by sa 4 0|creative commons attribution sharealike 4 0"),
    ("cc_by", "cc by 4 0|creative commons attribution 4 0"),
    ("cc0", "cc0 1 0|creative commons zero"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("mit_ref", "under the (terms of the )?mit license|spdx license identifier mit$|^mit license$"),
    ("bsd3_ref", "bsd 3 clause|3 clause bsd|spdx license identifier bsd 3 clause"),
    ("unknown", "(licensed|released|distributed|available) under |license agreement|all rights reserved|spdx license identifier"),
]
# Licences and the sentence sequences that make them, in the order in which they are tried.
RULES = [
    ("BSD-3-Clause", ["bsd_head", "bsd_source", "bsd_binary", "bsd_endorse", "bsd_warranty"]),
    ("BSD-2-Clause", ["bsd_head", "bsd_source", "bsd_binary", "bsd_warranty"]),
    ("Apache-2.0", ["apache2_ref", "apache_comply", "apache_copy", "apache_warranty"]),
    ("GPL-3.0-or-later", ["gpl_free", "gpl3_later", "gpl_warranty", "gpl_copy"]),
    ("MIT", ["mit_grant", "mit_notice", "mit_warranty"]),
    ("GPL-3.0-or-later", ["gpl_free", "gpl3_later", "gpl_warranty"]),
    ("GPL-3.0-or-later", ["gpl3_later"]),
    ("AGPL-3.0", ["agpl3_ref"]),
    ("LGPL-3.0", ["lgpl3_ref"]),
    ("GPL-3.0", ["gpl3_ref"]),
    ("GPL-2.0", ["gpl2_ref"]),
    ("MPL-2.0", ["mpl2_ref"]),
    ("Apache-2.0", ["apache2_ref"]),
    ("CC-BY-NC-SA-4.0", ["cc_by_nc_sa"]),
    ("CC-BY-NC-4.0", ["cc_by_nc"]),
    ("CC-BY-SA-4.0", ["cc_by_sa"]),
    ("CC-BY-4.0", ["cc_by"]),
    ("CC0-1.0", ["cc0"]),
    ("Unlicense", ["unlicense"]),
    ("MIT", ["mit_ref"]),
    ("BSD-3-Clause", ["bsd3_ref"]),
]
#: Every sentence pattern needs one of these; most sentences end here.
HINT = "licens|copyright|permission|redistribution|software|warrant|creative commons|cc by|cc0|bsd|rights reserved|under "
LINE = "(?:\\r?\\n|\\r(?!\\n))"
STOP = f"{LINE}[ \\t#*/;%|>-]*{LINE}|[.!?]+[ \\t\\n\\r]+|[.!?]+$"
#: Lines that are sentences of their own.
ALONE = "(?im)^([ \\t#*/;%|>-]*(?:spdx-licen[sc]e-identifier:.*|(?:the )?mit licen[sc]e[ \\t*/-]*))$"
#: Sentence ends of the SQL oracle, which splits at every line end and names one identifier a sentence.
END = "[\\n\\r]+|[.!?]+[ \\t\\n\\r]+|[.!?]+$"
UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _normal(s: Column) -> Column:
    s = F.replace(F.translate(s, UPPER, SMALL), F.lit("licence"), F.lit("license"))
    return F.trim(F.regexp_replace(s, "[^a-z0-9]+", " "))


def _identifiers(s: Column) -> Column:
    hits = []
    for k, (name, pattern) in enumerate(SENTENCES[:-1]):
        at = F.regexp_instr(s, F.lit(pattern))
        hits.append(F.when(s.rlike(pattern), F.struct(at.alias("at"), F.lit(k).alias("k"), (at + F.length(F.regexp_extract(s, pattern, 0))).alias("end"),
                                                       F.lit(f"<{name}>").alias("name"))))
    name, pattern = SENTENCES[-1]
    hits = F.filter(F.array(*hits), lambda h: h.isNotNull())
    # a transform over one element evaluates the hits once
    return F.when(~s.rlike(HINT), F.lit("")).otherwise(F.element_at(F.transform(F.array(hits), lambda hs: F.when(
        F.size(hs) == 0, F.when(s.rlike(pattern), F.lit(f"<{name}>")).otherwise(F.lit(""))).otherwise(F.array_join(F.transform(
            F.array_sort(F.filter(hs, lambda h: ~F.exists(hs, lambda g: (g["k"] < h["k"]) & (g["at"] <= h["at"]) & (g["end"] >= h["end"])))),
            lambda h: h["name"]), ""))), 1))


def _seq(ids: list[str]) -> str:
    return "".join(f"<{i}>" for i in ids)


def scan_licences(docs: DataFrame) -> DataFrame:
    """(doc_id, sentence_ids, licences, n_licences, n_unknown) of every row of ``docs`` (doc_id,
    text): ``sentence_ids`` is the sequence of identifiers as <a><b>, ``licences`` the sorted
    distinct licence names, comma-joined; ``n_unknown`` counts identifiers that no rule took.

    Defined cases: a null or empty text has no identifiers and no licence; rows count as they
    stand, also when they repeat; an empty table gives no rows; other columns are ignored."""
    text = F.regexp_replace(F.coalesce(F.col("text").cast("string"), F.lit("")), ALONE, "\n\n$1\n\n")
    normal = F.transform(F.split(text, STOP), _normal)
    parts = F.transform(normal, _identifiers)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.array_join(parts, "").alias("sentence_ids"))
    start = F.struct(F.col("sentence_ids").alias("left"), F.array().cast("array<string>").alias("found"))
    rules = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(_seq(s)).alias("seq")) for n, s in RULES])

    def take(acc: Column, rule: Column) -> Column:
        hit = F.contains(acc["left"], rule["seq"])
        return F.struct(F.when(hit, F.replace(acc["left"], rule["seq"], F.lit("<>"))).otherwise(acc["left"]).alias("left"),
                        F.when(hit, F.array_append(acc["found"], rule["name"])).otherwise(acc["found"]).alias("found"))

    done = rows.withColumn("m", F.when(F.col("sentence_ids") == "", start).otherwise(F.aggregate(rules, start, take)))
    names = F.array_sort(F.array_distinct("m.found"))
    left = F.regexp_replace("m.left", "<>", "")
    return done.select("doc_id", "sentence_ids", F.array_join(names, ",").alias("licences"), F.size(names).cast("long").alias("n_licences"),
                       (F.length(left) - F.length(F.replace(left, F.lit("<"), F.lit("")))).cast("long").alias("n_unknown"))


def oracle() -> str:
    """The same in DuckDB SQL over ``documents``."""
    q = lambda s: s.replace("'", "''")
    cases = " ".join(f"WHEN regexp_matches(s, '{q(p)}') THEN '<{n}>'" for n, p in SENTENCES)
    sql = f"""WITH sentences AS (
  SELECT doc_id, list_transform(list_transform(string_split_regex(coalesce(text, ''), '{END}'),
    lambda s: trim(regexp_replace(replace(translate(s, '{UPPER}', '{SMALL}'), 'licence', 'license'), '[^a-z0-9]+', ' ', 'g'))),
    lambda s: CASE WHEN NOT regexp_matches(s, '{HINT}') THEN '' {cases} ELSE '' END) AS ids FROM documents),
r0 AS (SELECT doc_id, array_to_string(ids, '') AS sentence_ids, array_to_string(ids, '') AS rest, CAST([] AS VARCHAR[]) AS found FROM sentences)"""
    for k, (name, seq) in enumerate(RULES):
        s = _seq(seq)
        sql += f""",
r{k + 1} AS (SELECT doc_id, sentence_ids, replace(rest, '{s}', '<>') AS rest,
  CASE WHEN contains(rest, '{s}') THEN list_append(found, '{name}') ELSE found END AS found FROM r{k})"""
    return sql + f"""
SELECT doc_id, sentence_ids, array_to_string(list_sort(list_distinct(found)), ',') AS licences,
  CAST(len(list_distinct(found)) AS BIGINT) AS n_licences,
  CAST(length(replace(rest, '<>', '')) - length(replace(replace(rest, '<>', ''), '<', '')) AS BIGINT) AS n_unknown FROM r{len(RULES)}"""
