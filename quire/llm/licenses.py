"""License scans by canonical digest lookup, with DataFrame functions only.

A text in canonical form has lower case, no copyright lines, one spelling of words with several, and single spaces
in place of punctuation; the digest of that form is joined with those of known licences. Whole documents are looked
up, and each line and paragraph as a text of its own, so that a notice in a document is found where it stands.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Spellings that licence texts use for the same word, and the one kept.
EQUIVALENT = [("licence", "license"), ("licenced", "licensed"), ("licences", "licenses"), ("acknowledgement", "acknowledgment"), ("authorisation", "authorization"), ("favour", "favor"), ("fulfil", "fulfill"), ("organisation", "organization"), ("recognise", "recognize"), ("sublicence", "sublicense"), ("whilst", "while"), ("wilful", "willful"), ("noncommercial", "non commercial"), ("per cent", "percent"), ("copyright owner", "copyright holder"), ("https", "http")]

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
BSD2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
BSD3 = BSD2.replace("\n\nTHIS SOFTWARE", "\n\n3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n\nTHIS SOFTWARE")

#: (SPDX name, text): licence texts, with and without their title, and the notices that stand for one.
KNOWN = [
    ("MIT", MIT),
    ("MIT", "MIT License\n\n" + MIT),
    ("MIT", "The MIT License (MIT)\n\n" + MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This work is licensed under the MIT License."),
    ("ISC", ISC),
    ("ISC", "ISC License\n\n" + ISC),
    ("ISC", "Licensed under the ISC License."),
    ("Apache-2.0", APACHE_NOTICE),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("BSD-2-Clause", BSD2),
    ("BSD-2-Clause", "BSD 2-Clause License\n\n" + BSD2),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", BSD3),
    ("BSD-3-Clause", "BSD 3-Clause License\n\n" + BSD3),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
]


# Copyright lines, behind comment marks too: with a year, or with a sign or placeholder that running text doesn't have
# after the word. "Copyright" and a bare name without a year isn't told from a wrapped line of a licence, and stays;
# "(c)" without a year is the mark of a clause.
OWNERS = r"(?m)^[ \t#/*;%!<>-]*(?:(?:copyright\b|\(c\)|©)[^\n]*[0-9]{4}[^\n]*|(?:copyright[ \t]*(?:\([ \t]*c[ \t]*\)|©|:|<|\[|\{)|©)[^\n]*)$|^[ \t#/*;%!<>-]*all rights reserved\.?[ \t]*$"

#: (SPDX name, digest) of long texts in canonical form: whole, and without what follows the terms. By digest() from Debian's
#: common licences; other editions of a text (the FSF's earlier addresses) have other digests.
DIGESTS = [
    ("Apache-2.0", "39ca6953ba8f1cb4ee91779ef11f3c2370e48117855acf5b28e3406e20b3ec3f"),
    ("Apache-2.0", "b9997b9a5dd4f84f1e63af19b181acfab398ce73dc80d8ee5614a48b3c5b3e50"),
    ("Apache-2.0", "9b78f51d932cd539684db1f1ba47ca4db4c0ee2fb3b567cb276756f761dd0e65"),
    ("Artistic-1.0-Perl", "8ab04e21a67c045e56bbc8239ab338a190781c6a4a9a3bd33cb6f8141ee9dc25"),
    ("BSD-3-Clause", "c259a82f87a240dd406de8df8a423e0d000cb6cc432de53e13db4870e471a949"),
    ("CC0-1.0", "1b1e1b0668e591dc12cc2c1f858df46627fa560d83b45f65c1b3df60188b525e"),
    ("CC0-1.0", "212224af9b922d8240be76710634c1947db17cb82ff9269cff6f176206e3f7fb"),
    ("CC0-1.0", "9728a3afab3c128dc61b39d8022dfb186f6b752b76ce52d0f099d9f3a680d7db"),
    ("GFDL-1.2", "bb0792f6db66c7d0e687ae158393208746e5e6bac68ba37bde38d30c340e34a6"),
    ("GFDL-1.3", "64c71d6ab1491ea99791fa19df74bf080c4f9d8005c8b8522f0246e1a30d8532"),
    ("GPL-1.0", "3836b031291e578c4855d28bdc87c53fc27b20dff7234528076113750d9b22f9"),
    ("GPL-1.0", "e5c43c4121913a4aa852e7c8a48188b192eee757e155710689f328f143e350d8"),
    ("GPL-1.0", "02e3515fafd775c1562d21e0f6f3d3325f018f8ba3efbadd83fde4132ed33c27"),
    ("GPL-2.0", "392c3818a570f9ff37a0265e6ebcd9f34100e381cb9e5e15c72b52ed3335dfb9"),
    ("GPL-2.0", "4b896a6a4b9d26022cdb4858bc9c10444c5ab63b3d76a435857f990efd8dfe63"),
    ("GPL-2.0", "8468f4adc1fff5f6ed6bdc3ecd6c251c34926ad3b8057f5d78f71758264bbe28"),
    ("GPL-3.0", "d90669fb6d1c01baed57dc18dc3b0dd5ad90e3a4e5e79e7d56dcd16699e0d843"),
    ("GPL-3.0", "ef472b47437a4164eafac24266d8ec60bfe835cab1018f8894a64b219ed4e9f7"),
    ("GPL-3.0", "217fc90513a5983909dfcc872e8fb0a5e756dea152a0453837400902f4c7de6c"),
    ("LGPL-2.0", "c240c0c7cd32f69796fadf571ea2ae65798be3e2dcd49d885a6892428943322a"),
    ("LGPL-2.0", "fbc49af13433930b5687809de62a7e47dc6fd9f35f14d4b284eff07e4a82117a"),
    ("LGPL-2.0", "a0b5c9a3709b9db2c0dab28467284c312758547ae666e382be1c7c75bab97892"),
    ("LGPL-2.1", "3c5cab0412f6274fe45e64786bb249da51c994fde68bcb825a626a1495d69a0e"),
    ("LGPL-2.1", "1c11e2f4f72a52688183139587fac7a1388a7d003e3c5c4ecf96e0421a985b48"),
    ("LGPL-2.1", "5795b17feb6d5a478854339c6c76f274ada8ea06c2ff245968e2f140a1e6ebf8"),
    ("LGPL-3.0", "8854f67344795b2c32a6117438109542910956a2779aec3dd280b9f7748b0c9b"),
    ("MPL-1.1", "c4b201de0f5ef0827eebcb80c31987416c3a1944353cf0b6bd1f5fab4057c137"),
    ("MPL-2.0", "209ee27067087ce012420bbfe7fd74996a53fedf54cf20682791ba6e707a2f51"),
    ("MPL-2.0", "c33e2d6b84852b0b20b1e7abd2e7679962d6338eb441d17964797d4cab50f105"),
]


def canonical(text: Column) -> Column:
    """Lower case, without copyright lines, two spaces for all else between words, one spelling per word."""
    x = F.regexp_replace(F.lower(text), OWNERS, " ")
    x = F.concat(F.lit(" "), F.trim(F.regexp_replace(x, r"[^\p{L}\p{N}]+", "  ")), F.lit(" "))
    for word, kept in EQUIVALENT:  # with two spaces between them, neighbours don't share one
        x = F.replace(x, F.lit(f" {word.replace(' ', '  ')} "), F.lit(f" {kept.replace(' ', '  ')} "))
    return x


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_licenses(spark: SparkSession, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """(license, digest), one row per digest, of (name, text) pairs; by default of KNOWN and DIGESTS."""
    rows = spark.createDataFrame(known or KNOWN, "license string, text string").select("license", digest(F.col("text")).alias("digest"))
    if not known:
        rows = rows.unionByName(spark.createDataFrame(DIGESTS, "license string, digest string"))
    return rows.groupBy("digest").agg(F.min("license").alias("license"))


#: Each notice and licence of KNOWN has one of these words, in every spelling.
TELLING = "(?i)licen|permission|redistribution|mozilla|mpl"


def scan(docs: DataFrame, known: DataFrame | None = None, telling: str | None = None) -> DataFrame:
    """docs (doc_id, text, ...) as (doc_id, text_digest, text_license, notice_licenses, n_notices), one row per row.

    text_license: the licence that the whole text is, else null. notice_licenses: sorted names of those that a line
    or a paragraph (between blank lines) of it is; n_notices: the number of such lines and paragraphs that differ.
    With known, (license, digest) rows of your own, every line and paragraph is looked up, unless `telling`, a pattern
    that all of those texts match, leaves the others out beforehand; without, TELLING does so for the texts of KNOWN.
    A null text has a null digest and no licence; an empty one has the digest of the empty form. Very long texts are
    looked up whole. Each row has its own notices, whether it repeats a doc_id or has none. Other columns of docs are
    left out, whatever their names; an empty table gives none.
    """
    parts = F.array_union(F.split("text", "\n"), F.split("text", r"\n[ \t\r]*\n"))
    whole = docs.select("doc_id", "text", digest(F.col("text")).alias("text_digest"))
    if known is None:
        # the module's own table has a few dozen rows, so it is a literal and each row finds its own notices; what cannot be
        # one, for want of any word that licences have, isn't normalised
        named = F.create_map(*[F.lit(x) for r in known_licenses(docs.sparkSession).collect() for x in (r["digest"], r["license"])])
        likely = F.filter(parts, lambda p: p.rlike(telling or TELLING))
        found = F.filter(F.array_distinct(F.transform(likely, digest)), lambda d: F.map_contains_key(named, d))
        found = F.when(F.col("text").rlike(telling or TELLING), found)
        rows = whole.select("doc_id", "text_digest", F.try_element_at(named, F.col("text_digest")).alias("text_license"), F.coalesce(found, F.array().cast("array<string>")).alias("found"))
        names = F.array_sort(F.array_distinct(F.transform("found", lambda d: F.try_element_at(named, d))))
        return rows.select("doc_id", "text_digest", "text_license", names.alias("notice_licenses"), F.size("found").cast("long").alias("n_notices"))
    # equal texts have equal notices, so a text's notices are found under its own digest, whatever the ids of its rows
    whole = whole.withColumn("text_key", F.sha2("text", 256))
    units = whole.where(F.col("text").rlike(telling)) if telling else whole
    units = units.select("text_key", F.explode(F.filter(parts, lambda p: p.rlike(telling)) if telling else parts).alias("part"))
    units = units.select("text_key", digest(F.col("part")).alias("digest"))
    notices = units.join(known, "digest").groupBy("text_key").agg(F.array_sort(F.collect_set("license")).alias("notice_licenses"), F.size(F.collect_set("digest")).cast("long").alias("n_notices"))
    texts = known.select(F.col("digest").alias("text_digest"), F.col("license").alias("text_license"))
    out = whole.drop("text").join(texts, "text_digest", "left").join(notices, "text_key", "left")
    return out.select("doc_id", "text_digest", "text_license", F.coalesce("notice_licenses", F.array().cast("array<string>")).alias("notice_licenses"), F.coalesce("n_notices", F.lit(0)).alias("n_notices"))


def oracle() -> str:
    """DuckDB SQL for scan() over documents and KNOWN."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"

    def digest_sql(x: str) -> str:
        x = f"regexp_replace(lower({x}), {quoted(OWNERS)}, ' ', 'g')"
        x = f"' ' || trim(regexp_replace({x}, '[^\\p{{L}}\\p{{N}}]+', '  ', 'g')) || ' '"
        for word, kept in EQUIVALENT:
            x = f"replace({x}, ' {word.replace(' ', '  ')} ', ' {kept.replace(' ', '  ')} ')"
        return f"sha256({x})"

    values = ", ".join(f"({quoted(name)}, {quoted(text)})" for name, text in KNOWN)
    digests = ", ".join(f"({quoted(name)}, {quoted(x)})" for name, x in DIGESTS)
    return f"""
WITH k AS (SELECT digest, min(license) AS license FROM (SELECT {digest_sql("text")} AS digest, license FROM (VALUES {values}) AS v(license, text)
        UNION ALL SELECT digest, license FROM (VALUES {digests}) AS x(license, digest)) GROUP BY 1),
u AS (SELECT DISTINCT doc_id, part FROM (
        SELECT doc_id, unnest(string_split(text, chr(10))) AS part FROM documents
        UNION ALL SELECT doc_id, unnest(regexp_split_to_array(text, '\\n[ \\t\\r]*\\n')) FROM documents)
      WHERE regexp_matches(part, {quoted(TELLING)})),
d AS (SELECT DISTINCT doc_id, {digest_sql("part")} AS digest FROM u),
n AS (SELECT doc_id, list_sort(list_distinct(list(license))) AS notice_licenses, count(*) AS n_notices FROM d JOIN k USING (digest) GROUP BY doc_id),
w AS (SELECT doc_id, {digest_sql("text")} AS text_digest FROM documents)
SELECT w.doc_id, w.text_digest, k.license AS text_license, coalesce(array_to_string(n.notice_licenses, ','), '') AS notice_licenses, coalesce(n.n_notices, 0) AS n_notices
FROM w LEFT JOIN k ON k.digest = w.text_digest LEFT JOIN n USING (doc_id)"""
