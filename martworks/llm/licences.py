"""Licence scans by sentence rules.

A text is brought into a plain form and cut into sentences; every known licence sentence in it, also several within
one, becomes an identifier, in order of position. The sequence of identifiers is then matched against licence rules in
order: a rule that matches names its licence and takes its identifiers out, so a full licence comes before the short
references that its sentences also contain. Everything is decided in the row: nothing is shuffled.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .common import computed, text_of

# Known licence sentences, in plain form; the first pattern that fits names the sentence.
SENTENCES: list[tuple[str, str]] = [
    ("spdx-mit", r"spdx-license-identifier: *mit\b"),
    ("spdx-apache-2", r"spdx-license-identifier: *apache-2\.0"),
    ("spdx-gpl-3-later", r"spdx-license-identifier: *gpl-3\.0(-or-later|\+)"),
    ("spdx-gpl-3", r"spdx-license-identifier: *gpl-3\.0"),
    ("spdx-gpl-2-later", r"spdx-license-identifier: *gpl-2\.0(-or-later|\+)"),
    ("spdx-gpl-2", r"spdx-license-identifier: *gpl-2\.0"),
    ("spdx-bsd-3", r"spdx-license-identifier: *bsd-3-clause"),
    ("spdx-bsd-2", r"spdx-license-identifier: *bsd-2-clause"),
    ("spdx-mpl-2", r"spdx-license-identifier: *mpl-2\.0"),
    ("spdx-isc", r"spdx-license-identifier: *isc\b"),
    ("mit-permission", r"permission is hereby granted, free of charge, to any person obtaining a copy"),
    ("mit-notice", r"the above copyright notice and this permission notice shall be included in all copies"),
    ("mit-warranty", r"the software is provided as is, without warranty of any kind, express or implied"),
    ("mit-liability", r"in no event shall the authors or copyright holders be liable for any claim"),
    ("boost-permission", r"permission is hereby granted, free of charge, to any person or organization obtaining a copy"),
    ("boost-notice", r"the copyright notices in the software and this entire statement"),
    ("zlib-warranty", r"this software is provided as-is, without any express or implied warranty"),
    ("zlib-permission", r"permission is granted to anyone to use this software for any purpose, including commercial applications"),
    ("zlib-origin", r"the origin of this software must not be misrepresented"),
    ("zlib-altered", r"altered source versions must be plainly marked as such"),
    ("zlib-notice", r"this notice may not be removed or altered from any source distribution"),
    ("isc-permission", r"permission to use, copy, modify, and/or distribute this software for any purpose with or without fee"),
    ("isc-warranty", r"the software is provided as is and the author disclaims all warranties"),
    ("bsd-redistribution", r"redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("bsd-source", r"redistributions of source code must retain the above copyright notice"),
    ("bsd-binary", r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-endorse", r"neither the name of .* may be used to endorse or promote products"),
    ("bsd-advertise", r"all advertising materials mentioning features or use of this software must display"),
    ("bsd-warranty", r"this software is provided by .* as is and any express or implied warranties"),
    ("apache-2-compliance", r"you may not use this file except in compliance with the license"),
    ("apache-2-copy", r"you may obtain a copy of the license at"),
    ("apache-2-warranty", r"software distributed under the license is distributed on an as is basis"),
    ("apache-2-limits", r"see the license for the specific language governing permissions and limitations"),
    ("apache-2", r"apache license,? ?\(?(version|v\.?) ?2(\.0)?|apache-2\.0|apache 2(\.0)? license"),
    ("agpl-3-later", r"gnu affero general public license.*version 3.*any later version"),
    ("agpl-3", r"gnu affero general public license|\bagpl-?(v|version )?3"),
    ("lgpl-later", r"gnu (lesser|library) general public license.*any later version"),
    ("lgpl-3", r"gnu lesser general public license.*(version|v) ?3|\blgpl-?v?3"),
    ("lgpl-2.1", r"gnu (lesser|library) general public license.*(version|v) ?2|\blgpl-?v?2"),
    ("lgpl", r"gnu (lesser|library) general public license"),
    ("gpl-3-later", r"gnu general public license.*(version|v) ?3.*any later version"),
    ("gpl-2-later", r"gnu general public license.*(version|v) ?2.*any later version"),
    ("gpl-3", r"gnu general public license,? *\(?(version|v) ?3|\bgpl-?v?3|gnu gpl,? (version|v)? ?3"),
    ("gpl-2", r"gnu general public license,? *\(?(version|v) ?2|\bgpl-?v?2|gnu gpl,? (version|v)? ?2"),
    ("gpl", r"gnu general public license|gnu gpl\b"),
    ("version-3-later", r"either version 3 of the license, or \(at your option\) any later version"),
    ("version-2-later", r"either version 2 of the license, or \(at your option\) any later version"),
    ("mpl-2", r"mozilla public license,? ?(version|v\.?) ?2|\bmpl-?2\.0"),
    ("epl-1", r"eclipse public license,? ?(-|version|v\.?) ?v? ?1|\bepl-1\.0"),
    ("epl-2", r"eclipse public license,? ?(-|version|v\.?) ?v? ?2|\bepl-2\.0"),
    ("boost", r"boost software license,? ?(-|version|v\.?) ?(version|v\.?)? ?1|\bbsl-1\.0"),
    ("zlib", r"\bzlib(/libpng)? licen[cs]e|licensed under (the )?zlib\b"),
    ("cc0", r"cc0 1\.0|creative commons zero|creativecommons\.org/publicdomain/zero"),
    ("unlicense", r"this is free and unencumbered software released into the public domain"),
    ("public-domain", r"(placed|released|is) (in|into|in to) the public domain"),
    ("bsd-3", r"\bbsd[ -]3[ -]clause|(3|three)[ -]clause bsd|\bnew bsd license"),
    ("bsd-2", r"\bbsd[ -]2[ -]clause|(2|two)[ -]clause bsd|simplified bsd license"),
    ("isc", r"\bisc license"),
    ("mit", r"\bmit[ -](style )?licen[cs]e|licensed under (the )?mit\b"),
    ("reserved", r"all rights reserved"),
]

# The kinds of Creative Commons licences as their addresses and titles have them, and their versions.
CC_KINDS = [
    ("by-nc-nd", "attribution-noncommercial-noderiv[a-z]*"), ("by-nc-sa", "attribution-noncommercial-sharealike"),
    ("by-nc", "attribution-noncommercial"), ("by-nd", "attribution-noderiv[a-z]*"), ("by-sa", "attribution-sharealike"),
    ("by", "creative commons attribution"),
]
CC_VERSIONS = ["1.0", "2.0", "2.5", "3.0", "4.0"]


def _cc(kind: str, version: str) -> str:
    """The identifier: ``cc-by-4`` for CC BY 4.0."""
    return f"cc-{kind}-{version.removesuffix('.0')}"


for _kind, _title in CC_KINDS:
    for _version in CC_VERSIONS:
        _v = _version.replace(".", r"\.")
        SENTENCES.append((_cc(_kind, _version), rf"cc[ -]{_kind}[ -]{_v}|creativecommons\.org/licenses/{_kind}/{_v}|{_title} {_v}"))

# Sequences of sentences and the licence they make, in the order in which they are tried.
RULES: list[tuple[str, list[str]]] = [
    ("MIT", ["mit-permission", "mit-notice", "mit-warranty", "mit-liability"]),
    ("MIT", ["mit-permission", "mit-notice", "mit-warranty"]),
    ("MIT", ["mit-permission", "mit-notice"]),
    ("BSL-1.0", ["boost-permission", "boost-notice", "mit-warranty"]),
    ("BSL-1.0", ["boost-permission", "boost-notice"]),
    ("Zlib", ["zlib-warranty", "zlib-permission", "zlib-origin", "zlib-altered", "zlib-notice"]),
    ("Zlib", ["zlib-permission", "zlib-origin", "zlib-altered"]),
    ("ISC", ["isc-permission", "isc-warranty"]),
    ("BSD-4-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary", "bsd-advertise", "bsd-endorse", "bsd-warranty"]),
    ("BSD-3-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-warranty"]),
    ("BSD-3-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("BSD-2-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary", "bsd-warranty"]),
    ("BSD-2-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary"]),
    ("Apache-2.0", ["apache-2", "apache-2-compliance", "apache-2-copy", "apache-2-warranty", "apache-2-limits"]),
    ("Apache-2.0", ["apache-2", "apache-2-compliance", "apache-2-copy"]),
    ("Apache-2.0", ["apache-2", "apache-2-compliance"]),
    ("Apache-2.0", ["apache-2-compliance", "apache-2-copy", "apache-2-warranty", "apache-2-limits"]),
    ("Apache-2.0", ["apache-2-compliance", "apache-2-copy"]),
    ("Apache-2.0", ["apache-2-compliance"]),
    ("GPL-3.0-or-later", ["gpl", "version-3-later"]),
    ("GPL-2.0-or-later", ["gpl", "version-2-later"]),
    ("MIT", ["spdx-mit"]), ("Apache-2.0", ["spdx-apache-2"]), ("GPL-3.0-or-later", ["spdx-gpl-3-later"]),
    ("GPL-3.0-only", ["spdx-gpl-3"]), ("GPL-2.0-or-later", ["spdx-gpl-2-later"]), ("GPL-2.0-only", ["spdx-gpl-2"]),
    ("BSD-3-Clause", ["spdx-bsd-3"]), ("BSD-2-Clause", ["spdx-bsd-2"]), ("MPL-2.0", ["spdx-mpl-2"]), ("ISC", ["spdx-isc"]),
    ("Apache-2.0", ["apache-2"]), ("AGPL-3.0-or-later", ["agpl-3-later"]), ("AGPL-3.0-only", ["agpl-3"]),
    ("LGPL-2.1-or-later", ["lgpl-later"]), ("LGPL-3.0-only", ["lgpl-3"]), ("LGPL-2.1-only", ["lgpl-2.1"]), ("LGPL", ["lgpl"]),
    ("GPL-3.0-or-later", ["gpl-3-later"]), ("GPL-2.0-or-later", ["gpl-2-later"]), ("GPL-3.0-only", ["gpl-3"]),
    ("GPL-2.0-only", ["gpl-2"]), ("GPL", ["gpl"]), ("MPL-2.0", ["mpl-2"]), ("EPL-1.0", ["epl-1"]), ("EPL-2.0", ["epl-2"]), ("CC0-1.0", ["cc0"]),
    ("BSL-1.0", ["boost"]), ("Zlib", ["zlib"]),
    ("Unlicense", ["unlicense"]), ("Public-Domain", ["public-domain"]), ("BSD-3-Clause", ["bsd-3"]),
    ("BSD-2-Clause", ["bsd-2"]), ("ISC", ["isc"]), ("MIT", ["mit"]),
]
RULES += [(f"CC-{kind.upper()}-{version}", [_cc(kind, version)]) for kind, _ in CC_KINDS for version in CC_VERSIONS]
#: What a text is whose known sentences are all this one; beside others it says nothing.
RESERVED, ALONE = "reserved", "Proprietary"
#: A statement that something is not under a licence, up to the next comma; without quotes, as in "isnt".
NEGATED = (r"\b(not|never|nor|no longer|isnt|arent|wasnt|werent)( (be|been|currently|yet|itself|hereby))* (licen[cs]ed|released|distributed"
           r"|available|published|covered|provided|offered|governed|made available) ([a-z]+ )?(under|by)\b[^\n,;]*")

MARKS = r"(?m)^[ \t]*(//+|#+|/\*+|\*+/?|--+|;+|>+|<!--)[ \t]*"
#: White space that ends a sentence without a stop: after a colon at the end of a line, blank lines, before list marks and SPDX tags.
ENDS = (r"(?<![\x20\x09-\x0D])(?=[\x20\x09-\x0D])(?:(?<=(?<!spdx-license-identifier):)[ \t]*[\r\n][\x20\x09-\x0D]*"
        r"|[ \t]*(?:\r\n?|\n)[ \t\x0B\f]*[\r\n][\x20\x09-\x0D]*"
        r"|(?<!version)(?<!\bv)[ \t]*(?:\r\n?|\n)[ \t]*(?=(?:[-+\u2022\u2013]|\(?[0-9a-z]{1,2}[.)])[ \t])"
        r"|[\x20\x09-\x0D]+(?=spdx-license-identifier))")
QUOTES = "\"'`“”‘’"


def _sequence(ids: list[str]) -> str:
    return "".join(f"<{i}>" for i in ids)


def _in_order(ids: list[str]) -> str:
    """The identifiers one after the other, others between them."""
    return "((?:<[^>]*>)*?)".join(f"<{re.escape(i)}>" for i in ids)


# Names of licences: the gap in a known sentence does not run over the name of another one.
NAMES = {"gpl": r"gnu general public license|gnu gpl\b|\bgpl-?v?\d", "lgpl": r"gnu (?:lesser|library) general public license|\blgpl\b",
         "agpl": r"gnu affero general public license|\bagpl\b",
         "": r"apache license|apache-2|mozilla public|\bmpl-?2|eclipse public|\bcc0 |\bcc by|creative ?commons|\bbsd[ -]\d|"
             r"\w-clause bsd|bsd license|\bisc license|\bmit[ -](?:style )?licen[cs]e|spdx-license-identifier|public domain|all rights reserved"}
#: What belongs to a known sentence before its pattern.
HEADS = {"apache-2-compliance": r"(?:licensed under the apache license,? version 2\.0 \(the license\)[;,]? ?)?"}


def _spaces(pattern: str) -> str:
    """A blank of a pattern is also the end of a line that ended a sentence: a known sentence set with blank lines in it."""
    return re.sub(r"(\[[^\]]*\])|( )", lambda m: m[1].replace(" ", r" \n") if m[1] else r"[ \n]", pattern)


def _positional(name: str, pattern: str) -> str:
    """The pattern with the shortest gaps, which stay in a sentence and off other licences and their versions."""
    family = name.split("-")[0]
    if family in NAMES:
        others = "|".join(p for f, p in NAMES.items() if f != family)
        first, *rest = pattern.split(".*")
        gaps = [rf"(?:(?!{others}|(?:version|v) ?\d)[^\n])*?", rf"(?:(?!{others}|{NAMES[family]})[^\n])*?"]
        pattern = first + "".join(g + p for g, p in zip(gaps, rest))
    return _spaces(HEADS.get(name, "") + pattern.replace(".*", r"[^\n]*?"))


KNOWN = [(name, _positional(name, pattern)) for name, pattern in SENTENCES]
#: Every pattern has one of these words in each alternative, so a text without any, quotes off, holds no known sentence.
WORDS = ("licen copyright permission warrant redistribut endorse advertising apache gpl mpl cc0 creative 4.0 public bsd "
         "reserved later attribution eclipse boost bsl- epl- zlib as-is misrepresented altered").split() + ["cc by", "cc-by"]


def _by_letter(patterns: list[str]) -> str:
    """One pattern for all, tried by first letter; the order of those with the same letter stays."""
    groups: dict[str, list[str]] = {}
    for pattern in patterns:
        for alternative in _alternatives(pattern):
            groups.setdefault(_first(alternative), []).append(alternative)
    return "|".join(f"(?={first})(?:{'|'.join(found)})" for first, found in groups.items())


def _alternatives(pattern: str) -> list[str]:
    """The alternatives of a pattern outside all parentheses."""
    out, depth = [""], 0
    for i, c in enumerate(pattern):
        depth += (c in "()" and pattern[i - 1] != "\\") * (1 if c == "(" else -1)
        out = [*out, ""] if c == "|" and not depth else [*out[:-1], out[-1] + c]
    return out


def _first(alternative: str) -> str:
    """The first letters that it can have, as a class."""
    plain = re.sub(r"^\\b", "", alternative)
    if plain[0] != "(":
        return f"[{plain[0]}]"
    group, rest = re.match(r"\((?:\?:)?([^()\\]*(?:\\.[^()\\]*)*)\)(.*)", plain, re.S).groups()
    letters = "".join(x[0] for x in group.split("|"))
    return f"[{letters}{rest[1:2] if rest[0] == '?' else ''}]"


ANY_KNOWN = _by_letter([pattern for _, pattern in KNOWN])


def plain(text: Column) -> Column:
    """The text in plain form, a sentence a line: comment marks and quotes off, lower case, white space single. A
    sentence ends at a full stop, question or exclamation mark before white space, at a blank line, at a colon that
    ends its line, before a list mark and before an SPDX tag; other line breaks are blanks."""
    out = F.lower(F.translate(F.regexp_replace(text, MARKS, ""), QUOTES, ""))
    out = F.regexp_replace(out, ENDS, "\u0000")
    out = F.regexp_replace(F.regexp_replace(out, r"[\x20\x09-\x0D]+", " "), r"([.!?]) ", "$1\n")
    return F.regexp_replace(F.translate(out, "\u0000", "\n"), NEGATED, " ")


def identified(match: Column) -> Column:
    """The identifier of a whole match of ANY_KNOWN: the first pattern that fits."""
    out = F.when(match.rlike(f"^(?:{KNOWN[0][1]})$"), F.lit(KNOWN[0][0]))
    for name, pattern in KNOWN[1:]:
        out = out.when(match.rlike(f"^(?:{pattern})$"), F.lit(name))
    return out


def scan(docs: DataFrame) -> DataFrame:
    """Per row ``doc_id``, ``sentences`` (the identifiers in order), ``licences`` (each once, in the order of the rules)
    and ``unmatched`` (identifiers that no rule takes). Identifiers of other licences may stand between those of a rule.
    That all rights are reserved makes a text proprietary only if it has no other known sentence.

    A text without a known sentence, an empty and a null one have empty lists. Repeated rows give a result each.
    """
    text = text_of()
    empty = F.array().cast("array<string>")
    rows = computed(docs.select("doc_id", text.alias("_given")), _low=F.lower(F.translate("_given", QUOTES, "")))
    may = reduce(Column.__or__, [F.contains("_low", F.lit(w)) for w in WORDS])
    rows = computed(rows.select("doc_id", F.when(may, F.col("_given")).alias("_given")), _text=plain(F.col("_given")))
    rows = computed(rows, _known=F.when(F.col("_text").isNotNull(), F.regexp_extract_all("_text", F.lit(ANY_KNOWN), F.lit(0))).otherwise(empty))
    rows = computed(rows, sentences=F.transform("_known", identified))
    others = F.filter("sentences", lambda x: x != RESERVED)
    rules = F.array(*[F.struct(F.lit(f"<{ids[0]}>").alias("first"), F.lit(_in_order(ids)).alias("ids"),
                               F.lit("".join(f"${i}" for i in range(1, len(ids)))).alias("left"), F.lit(name).alias("name")) for name, ids in RULES])
    start = F.struct(F.concat(F.lit(""), F.array_join(F.transform(others, lambda x: F.concat(F.lit("<"), x, F.lit(">"))), "")).alias("rest"),
                     empty.alias("found"))
    matched = F.aggregate(rules, start, lambda state, rule: F.when(
        F.contains(state["rest"], rule["first"]) & F.rlike(state["rest"], rule["ids"]),
        F.struct(F.regexp_replace(state["rest"], rule["ids"], rule["left"]).alias("rest"),
                 F.concat(state["found"], F.array(rule["name"])).alias("found"))).otherwise(state))
    nothing = F.struct(F.lit("").alias("rest"), empty.alias("found"))
    alone = F.struct(F.lit("").alias("rest"), F.array(F.lit(ALONE)).alias("found"))
    rows = computed(rows, _state=F.when(F.size("sentences") == 0, nothing).when(F.size(others) == 0, alone).otherwise(matched))
    return rows.select("doc_id", "sentences", F.array_distinct("_state.found").alias("licences"),
                       F.length(F.regexp_replace("_state.rest", "[^<]", "")).alias("unmatched"))


def scan_sql(source: str = "documents") -> str:
    """The scan as SQL, with lists as text joined by commas. This SQL cannot look around in a pattern: a sentence ends at
    stops only and has one identifier, the first that fits. It agrees with ``scan`` where a text has its licences in
    separate sentences."""
    def quoted(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    plain = f"lower(translate(regexp_replace(coalesce(text, ''), {quoted(MARKS)}, '', 'g'), {quoted(QUOTES)}, ''))"
    plain = f"regexp_replace({plain}, '[\\x20\\x09-\\x0D]+', ' ', 'g')"
    plain = f"regexp_replace(regexp_replace({plain}, '([.!?]) ', '\\1' || chr(10), 'g'), {quoted(NEGATED)}, ' ', 'g')"
    cases = " ".join(f"WHEN regexp_matches(x, {quoted(p)}) THEN {quoted(n)}" for n, p in SENTENCES)
    left = ["".join(f"\\{i}" for i in range(1, len(ids))) for _, ids in RULES]
    steps = ", ".join(f"regexp_replace(s{i}, {quoted(_in_order(ids))}, {quoted(left[i])}, 'g') AS s{i + 1}" for i, (_, ids) in enumerate(RULES))
    hits = ", ".join(f"CASE WHEN regexp_matches(s{i}, {quoted(_in_order(ids))}) THEN {quoted(name)} END" for i, (name, ids) in enumerate(RULES))
    # Each licence once, where it is first found.
    return f"""
WITH a AS (SELECT doc_id, string_split({plain}, chr(10)) AS known FROM {source}),
  b AS (SELECT doc_id, list_filter(list_transform(known, lambda x: CASE {cases} END), lambda x: x IS NOT NULL) AS ids FROM a),
  c AS (SELECT doc_id, ids, list_filter(ids, lambda x: x <> '{RESERVED}') AS others FROM b),
  d AS (SELECT doc_id, ids, others, array_to_string(list_transform(others, lambda x: '<' || x || '>'), '') AS s0, {steps} FROM c),
  e AS (SELECT doc_id, ids, s{len(RULES)} AS rest, CASE WHEN len(ids) > 0 AND len(others) = 0 THEN ['{ALONE}']
          ELSE list_filter([{hits}], lambda x: x IS NOT NULL) END AS found FROM d)
SELECT doc_id, array_to_string(ids, ',') AS sentences,
  array_to_string(list_filter(found, lambda x, i: list_position(found, x) = i), ',') AS licences,
  length(regexp_replace(rest, '[^<]', '', 'g')) AS unmatched
FROM e
"""
