from __future__ import annotations

import duckdb
from pyspark.sql import functions as F

import corpus
from martworks.llm import licences as L

MIT = """// Permission is hereby granted, free of charge, to any person obtaining a copy
// of this software. The above copyright notice and this permission notice shall be
// included in all copies. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY
// KIND, EXPRESS OR IMPLIED. In no event shall the authors or copyright holders be liable for any claim."""
APACHE = """# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"""
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted. Redistributions of
source code must retain the above copyright notice. Redistributions in binary form must reproduce the above copyright notice.
Neither the name of the X nor its contributors may be used to endorse or promote products. This software is provided by the
holders "as is" and any express or implied warranties are disclaimed."""

CASES = [
    (MIT, ["MIT"]), (BSD, ["BSD-3-Clause"]), (BSD.split("Neither")[0], ["BSD-2-Clause"]), ("Licensed under CC BY-NC 4.0.", ["CC-BY-NC-4.0"]),
    ("This work is licensed under the GNU General Public License, version 3.", ["GPL-3.0-only"]),
    ("Licensed under the Apache License, Version 2.0.", ["Apache-2.0"]), ("Released under the MIT License.", ["MIT"]),
    ("GNU General Public License as published. Either version 3 of the License, or (at your option) any later version.", ["GPL-3.0-or-later"]),
    ("x\nReleased under the MIT License.\nReleased under the MIT License.\ny", ["MIT"]),
    (MIT + "\nAlso see the ISC License. All rights reserved.", ["MIT", "ISC"]),
    ("SPDX-License-Identifier: Apache-2.0", ["Apache-2.0"]), ("The GNU Lesser General Public License, version 2.1.", ["LGPL-2.1-only"]),
    ("We granted permission to nobody and no warranty.", []), ("", []), (None, []), ("no such words", []),
    (APACHE, ["Apache-2.0"]), ("Permission is hereby granted, free of charge, to any person obtaining a copy.", [])]


def rows(spark):
    long = corpus.sentence(corpus.random.Random(0), 40_000) + ". Released under the MIT License. " + corpus.sentence(corpus.random.Random(1), 40_000)
    cases = [*CASES, (long, ["MIT"])]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)] + [(None, "Released under the MIT License."), (0, MIT)], "doc_id long, text string")
    return cases, df.withColumns({"licences": F.lit("l"), "sentences": F.lit(1)})


def test_known_licences(spark):
    cases, df = rows(spark)
    got = L.scan(df).collect()
    assert len(got) == len(cases) + 2
    assert {r.doc_id: r.licences for r in got if r.doc_id is not None} == {i: x for i, (_, x) in enumerate(cases)}
    left = {r.doc_id: r.unmatched for r in got}
    assert left[17] == 1 and left[1] == 0
    assert L.scan(df.limit(0)).count() == 0


def test_sql_agrees(spark):
    _, df = rows(spark)
    con = duckdb.connect()
    con.register("documents", df.select("doc_id", "text").toPandas().astype({"doc_id": "Int64"}))
    want = con.execute(L.scan_sql()).fetchall()
    got = [(r.doc_id, ",".join(r.sentences), ",".join(r.licences), r.unmatched) for r in L.scan(df).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_rules_name_known_sentences():
    known = [name for name, _ in L.SENTENCES]
    assert len(known) == len(set(known))
    assert {i for _, ids in L.RULES for i in ids} <= set(known)
    # A rule behind a shorter part of itself would never match.
    sequences = [L._sequence(ids) for _, ids in L.RULES]
    assert all(a not in b for i, a in enumerate(sequences) for b in sequences[i + 1:])


MIT_VERBATIM = """MIT License

Copyright (c) 2020 A. Person

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
MIT_IDS = ["mit", "mit-permission", "mit-notice", "mit-warranty", "mit-liability"]
BSD_BULLETS = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
{0} Redistributions of source code must retain the above copyright notice,
  this list of conditions and the following disclaimer.
{0} Redistributions in binary form must reproduce the above copyright notice,
  this list of conditions and the following disclaimer in the documentation
{0} Neither the name of the X nor the names of its contributors may be used to
  endorse or promote products derived from this software
THIS SOFTWARE IS PROVIDED BY THE HOLDERS ``AS IS'' AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED."""
BSD_IDS = ["bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-warranty"]
APACHE_VERBATIM = """   Licensed under the Apache License, Version 2.0 (the "License");
   you may not use this file except in compliance with the License.
   You may obtain a copy of the License at

       http://www.apache.org/licenses/LICENSE-2.0

   Unless required by applicable law or agreed to in writing, software
   distributed under the License is distributed on an "AS IS" BASIS,
   WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
   See the License for the specific language governing permissions and
   limitations under the License.
"""
APACHE_IDS = ["apache-2-compliance", "apache-2-copy", "apache-2-warranty", "apache-2-limits"]
WHOLE = [
    (MIT_VERBATIM, MIT_IDS, ["MIT"]), (MIT_VERBATIM.replace("\n", "\r\n"), MIT_IDS, ["MIT"]), (MIT_VERBATIM.replace("\n", "\n\n"), MIT_IDS, ["MIT"]),
    (" ".join(MIT_VERBATIM.split()), MIT_IDS, ["MIT"]), ("/*\n" + MIT_VERBATIM.replace("\n", "\n * ") + "/", MIT_IDS, ["MIT"]),
    *[(BSD_BULLETS.format(mark), BSD_IDS, ["BSD-3-Clause"]) for mark in ("*", "-", "\u2022", "1.", "(a)")],
    (APACHE_VERBATIM, APACHE_IDS, ["Apache-2.0"]), ("Apache License\nVersion 2.0, January 2004\n" + APACHE_VERBATIM, ["apache-2", *APACHE_IDS], ["Apache-2.0"]),
    ("// SPDX-License-Identifier: MIT\n// SPDX-License-Identifier: Apache-2.0\n# SPDX-License-Identifier: GPL-2.0-or-later",
     ["spdx-mit", "spdx-apache-2", "spdx-gpl-2-later"], ["MIT", "Apache-2.0", "GPL-2.0-or-later"]),
    ("SPDX-License-Identifier: MIT OR Apache-2.0", ["spdx-mit", "apache-2"], ["MIT", "Apache-2.0"]),
    ("Under the MIT License, the Apache License, Version 2.0 or again the MIT License", ["mit", "apache-2", "mit"], ["Apache-2.0", "MIT"]),
    ("the GNU General Public License, the MIT License, or the Mozilla Public License version 2 and any later version", ["gpl", "mit", "mpl-2"], ["GPL", "MPL-2.0", "MIT"]),
    ("GNU General Public License (GNU GPL) as published, version 3\nor any later version", ["gpl-3-later"], ["GPL-3.0-or-later"]),
    ("GNU General Public License, version\n3. It is so", ["gpl-3"], ["GPL-3.0-only"]),
    ("GNU General Public License as published by the Foundation, either version 3 of the License, or (at your option) any later version",
     ["gpl-3-later"], ["GPL-3.0-or-later"]),
    ("- GNU General Public License\n- The other one, version 3 or any later version", ["gpl"], ["GPL"]),
    ("GNU General Public License " + "word " * 60_000 + "the MIT License", ["gpl", "mit"], ["GPL", "MIT"])]


def test_every_sentence_counts(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(WHOLE)], "doc_id long, text string")
    got = {r.doc_id: r for r in L.scan(df).collect()}
    assert {i: r.sentences for i, r in got.items()} == {i: ids for i, (_, ids, _) in enumerate(WHOLE)}
    assert {i: r.licences for i, r in got.items()} == {i: names for i, (_, _, names) in enumerate(WHOLE)}


# A sentence for each alternative of each pattern, as it is, in its order.
SAMPLES = {
    "spdx-mit": ["SPDX-License-Identifier: MIT"], "spdx-apache-2": ["SPDX-License-Identifier: Apache-2.0"],
    "spdx-gpl-3-later": ["SPDX-License-Identifier: GPL-3.0+"], "spdx-gpl-3": ["SPDX-License-Identifier: GPL-3.0-only"],
    "spdx-gpl-2-later": ["SPDX-License-Identifier: GPL-2.0-or-later"], "spdx-gpl-2": ["SPDX-License-Identifier: GPL-2.0"],
    "spdx-bsd-3": ["SPDX-License-Identifier: BSD-3-Clause"], "spdx-bsd-2": ["SPDX-License-Identifier: BSD-2-Clause"],
    "spdx-mpl-2": ["SPDX-License-Identifier: MPL-2.0"], "spdx-isc": ["SPDX-License-Identifier: ISC"],
    "mit-permission": ["Permission is hereby granted, free of charge, to any person obtaining a copy"],
    "mit-notice": ["The above copyright notice and this permission notice shall be included in all copies"],
    "mit-warranty": ['The software is provided "as is", without warranty of any kind, express or implied'],
    "mit-liability": ["In no event shall the authors or copyright holders be liable for any claim"],
    "boost-permission": ["Permission is hereby granted, free of charge, to any person or organization obtaining a copy"],
    "boost-notice": ["The copyright notices in the Software and this entire statement"],
    "zlib-warranty": ["This software is provided 'as-is', without any express or implied warranty"],
    "zlib-permission": ["Permission is granted to anyone to use this software for any purpose, including commercial applications"],
    "zlib-origin": ["The origin of this software must not be misrepresented"],
    "zlib-altered": ["Altered source versions must be plainly marked as such"],
    "zlib-notice": ["This notice may not be removed or altered from any source distribution"],
    "isc-permission": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee"],
    "isc-warranty": ['The software is provided "as is" and the author disclaims all warranties'],
    "bsd-redistribution": ["Redistribution and use in source and binary forms, with or without modification, are permitted"],
    "bsd-source": ["Redistributions of source code must retain the above copyright notice"],
    "bsd-binary": ["Redistributions in binary form must reproduce the above copyright notice"],
    "bsd-endorse": ["Neither the name of the X nor others may be used to endorse or promote products"],
    "bsd-advertise": ["All advertising materials mentioning features or use of this software must display"],
    "bsd-warranty": ["This software is provided by the X as is and any express or implied warranties"],
    "apache-2-compliance": ["you may not use this file except in compliance with the License"],
    "apache-2-copy": ["You may obtain a copy of the License at"],
    "apache-2-warranty": ['software distributed under the License is distributed on an "AS IS" BASIS'],
    "apache-2-limits": ["See the License for the specific language governing permissions and limitations"],
    "apache-2": ["Apache License, Version 2.0", "Apache-2.0", "Apache 2.0 license"],
    "agpl-3-later": ["GNU Affero General Public License, version 3 or any later version"],
    "agpl-3": ["GNU Affero General Public License", "AGPLv3"],
    "lgpl-later": ["GNU Library General Public License, or any later version"],
    "lgpl-3": ["GNU Lesser General Public License, version 3", "LGPL-3"],
    "lgpl-2.1": ["GNU Lesser General Public License, version 2.1", "LGPLv2.1"], "lgpl": ["GNU Lesser General Public License"],
    "gpl-3-later": ["GNU General Public License, version 3 or any later version"],
    "gpl-2-later": ["GNU General Public License, version 2 or any later version"],
    "gpl-3": ["GNU General Public License, version 3", "GPLv3", "GNU GPL version 3"],
    "gpl-2": ["GNU General Public License (v2)", "GPL-2", "GNU GPL, version 2"], "gpl": ["GNU General Public License", "GNU GPL"],
    "version-3-later": ["either version 3 of the License, or (at your option) any later version"],
    "version-2-later": ["either version 2 of the License, or (at your option) any later version"],
    "mpl-2": ["Mozilla Public License, v. 2.0", "MPL-2.0"], "epl-1": ["Eclipse Public License - v 1.0", "EPL-1.0"], "epl-2": ["Eclipse Public License - v 2.0", "EPL-2.0"],
    "boost": ["Boost Software License - Version 1.0", "BSL-1.0"], "zlib": ["zlib/libpng license", "licensed under the zlib"],
    "cc0": ["CC0 1.0", "Creative Commons Zero", "https://creativecommons.org/publicdomain/zero/1.0/"],
    "unlicense": ["This is free and unencumbered software released into the public domain"], "public-domain": ["It is in the public domain"],
    "bsd-3": ["BSD-3-Clause", "3-clause BSD", "New BSD License"], "bsd-2": ["BSD 2-Clause", "two-clause BSD", "Simplified BSD License"],
    "isc": ["ISC License"], "mit": ["MIT-style licence", "licensed under MIT"], "reserved": ["All rights reserved"],
    **{f"cc-{kind}-{version.removesuffix('.0')}": [f"CC {kind.upper()} {version}", f"https://creativecommons.org/licenses/{kind}/{version}/", f"{name} {version}"]
       for kind, name in [
        ("by-nc-nd", "Attribution-NonCommercial-NoDerivatives"), ("by-nc-sa", "Attribution-NonCommercial-ShareAlike"),
        ("by-nc", "Attribution-NonCommercial"), ("by-nd", "Attribution-NoDerivatives"), ("by-sa", "Attribution-ShareAlike"),
        ("by", "Creative Commons Attribution")] for version in ("1.0", "2.0", "2.5", "3.0", "4.0")}}


def alternatives(pattern: str) -> list[str]:
    out, depth = [""], 0
    for i, c in enumerate(pattern):
        depth += (c in "()" and pattern[i - 1] != "\\") * (1 if c == "(" else -1)
        out = [*out, ""] if c == "|" and not depth else [*out[:-1], out[-1] + c]
    return out


def test_every_alternative_is_found(spark):
    cases = [(name, sample) for name, samples in SAMPLES.items() for sample in samples]
    assert [name for name, _ in cases] == [name for name, p in L.SENTENCES for _ in alternatives(p)]
    for (name, sample), alternative in zip(cases, [a for _, p in L.SENTENCES for a in alternatives(p)]):
        assert L.re.search(alternative, sample.lower().replace('"', "").replace("'", "")), (name, alternative)
    frames = ["{}", "x {} y", "Released here: {}.\n\nNothing else."]
    df = spark.createDataFrame([(i, f.format(sample)) for i, (f, (_, sample)) in enumerate((f, c) for f in frames for c in cases)], "doc_id long, text string")
    got = {r.doc_id: r.sentences for r in L.scan(df).collect()}
    assert [got[i] for i in range(len(got))] == [[name] for name, _ in cases] * len(frames)


ISC = """Copyright (c) 2020 A. Person. All rights reserved.

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE."""
ZLIB = """Copyright (c) 2020 A. Person. All rights reserved.

This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not
   claim that you wrote the original software.
2. Altered source versions must be plainly marked as such, and must not be
   misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
BOOST = """Boost Software License - Version 1.0 - August 17th, 2003

Permission is hereby granted, free of charge, to any person or organization
obtaining a copy of the software and accompanying documentation covered by
this license (the "Software") to use, reproduce, display, distribute,
execute, and transmit the Software, all subject to the following:

The copyright notices in the Software and this entire statement, including
the above license grant, must be included in all copies of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED."""
REGENTS = "Copyright (c) 2020, A. Person\nAll rights reserved.\n\n"
ONE_EACH = [
    (ISC, "ISC"), (ZLIB, "Zlib"), (BOOST, "BSL-1.0"), (REGENTS + BSD_BULLETS.format("*"), "BSD-3-Clause"), (REGENTS + MIT_VERBATIM, "MIT"),
    (MIT_VERBATIM.replace("THE SOFTWARE IS PROVIDED", "All rights reserved.\n\nTHE SOFTWARE IS PROVIDED"), "MIT"),
    (REGENTS + APACHE_VERBATIM, "Apache-2.0"), ("Eclipse Public License - v 1.0\n\n" + REGENTS, "EPL-1.0"),
    ("Licensed under CC BY-SA 3.0. " + REGENTS, "CC-BY-SA-3.0"), ("SPDX-License-Identifier: CC-BY-4.0", "CC-BY-4.0"), (REGENTS, "Proprietary")]
NONE = ["This is not licensed under the MIT License.", "It isn't currently distributed under the GNU GPL.", "Never released under CC BY 4.0; ask."]


def test_one_licence_each(spark):
    texts = [t for t, _ in ONE_EACH] + NONE + ["Not licensed under the MIT License, but under the ISC License.", "You may not copy. Licensed under the MIT License."]
    got = {r.doc_id: r.licences for r in L.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [got[i] for i in range(len(texts))] == [[n] for _, n in ONE_EACH] + [[]] * len(NONE) + [["ISC"], ["MIT"]]


def in_python(text):
    """(identifiers, licences, how many no rule takes): patterns tried one by one at every place, rules by hand."""
    out = L.re.sub(L.MARKS, "", text or "")
    out = "".join(c for c in out if c not in L.QUOTES).lower()
    out = L.re.sub(r"[\x20\x09-\x0D]+", " ", L.re.sub(L.ENDS, "\0", out))
    out = L.re.sub(L.NEGATED, " ", L.re.sub(r"([.!?]) ", "\\1\n", out).replace("\0", "\n"))
    ids, at, known = [], 0, [(n, L.re.compile(p)) for n, p in L.KNOWN]
    while at < len(out):
        hit = next(((n, m) for n, p in known if (m := p.match(out, at)) and m.end() > at), None)
        ids += [hit[0]] if hit else []
        at = hit[1].end() if hit else at + 1
    rest, found = [i for i in ids if i != "reserved"], []
    if ids and not rest:
        return ids, ["Proprietary"], 0
    for name, wanted in L.RULES:
        while True:
            places, start = [], 0
            for w in wanted:
                if w not in rest[start:]:
                    break
                places.append(rest.index(w, start))
                start = places[-1] + 1
            if len(places) < len(wanted):
                break
            rest = [x for i, x in enumerate(rest) if i not in places]
            found += [name] if name not in found else []
    return ids, found, len(rest)


def test_equals_plain_python(spark):
    rng = corpus.random.Random(11)
    samples = [x for many in SAMPLES.values() for x in many]
    texts = [t for t, _ in CASES] + [t for t, _ in ONE_EACH] + [t for t, _, _ in WHOLE[:-1]] + NONE
    texts += [rng.choice([". ", "\n\n", ", ", "\n- "]).join(rng.sample(samples, 5) + [corpus.sentence(rng, 6)]) for _ in range(60)]
    got = {r.doc_id: (r.sentences, r.licences, r.unmatched) for r in L.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == in_python(t), t
