"""License scan by canonical digest.

A text is brought to a canonical form (lower case; copyright notices dropped; equivalent spellings unified; runs of
anything but letters and digits become one space, so line breaks do not matter) and its digest is joined to the digests of
known licence texts by a hash join; the fixed table is small, so it is broadcast (texts that the caller adds are not).
`scan_notices` does the same for each line that speaks of a licence. Known whole texts: those of KNOWN and KNOWN_DIGESTS
(with and without the appendix on how to apply them); of the CC BY family only one-line notices are known.
Edge cases: a null text is empty and has the digest of the empty form, which no licence has; very long texts are read
whole; a digest of two licences (a tie) goes to the name that sorts first; repeated rows are scanned alike; an empty table
gives no rows; extra columns pass through, and the output columns replace columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm.common import text_or_empty

# Public licence texts and notices.
_GRANT_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_END = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_TWO = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
KNOWN = [
    ("MIT", "MIT License\n\n" + _GRANT_MIT),
    ("MIT", _GRANT_MIT),
    ("ISC", f"ISC License\n\n{_ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all copies.\n\n{_ISC_END}"),
    ("ISC", f"{_ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all copies.\n\n{_ISC_END}"),
    ("0BSD", f"{_ISC_GRANT}.\n\n{_ISC_END}"),
    ("BSD-2-Clause", "\n\n".join(("BSD 2-Clause License", _BSD_TWO, _BSD_END))),
    ("BSD-2-Clause", "\n\n".join((_BSD_TWO, _BSD_END))),
    ("BSD-3-Clause", "\n\n".join(("BSD 3-Clause License", _BSD_TWO, _BSD_THIRD, _BSD_END))),
    ("BSD-3-Clause", "\n\n".join((_BSD_TWO, _BSD_THIRD, _BSD_END))),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
]
# SHA-256 of the canonical form of long public licence texts, each whole, without what follows its last term, and without that closing line.
KNOWN_DIGESTS = [
    ("Apache-2.0", "04e64e0427d80fdde16fa8415931bf2c09bc943f13ec322a09df188bf23a3543"),
    ("Apache-2.0", "119e2da0e9ec849d113a40405b338c1bbbd2ef9194c22bf2740fa4e195411c40"),
    ("Apache-2.0", "824065d72ca31b7c727341396be4cf76f464b15d9bef680a3638007ce92a009f"),
    ("CC0-1.0", "cccf7894e1b9f4ba9f97728bf0c5baf9e07bc2ac93da7a51556451b1fb2b868e"),
    ("GPL-2.0", "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821"),
    ("GPL-2.0", "e1270b653c300290e7c039142bccb8776f9b5d14e8a05bc4e87dc7d1614a3b34"),
    ("GPL-2.0", "6d332dc4c3c5293a73c6c9da402f9bbc970b3bb1eb472f577e00580573469808"),
    ("GPL-3.0", "a8cd54d6683aa630f0b8d05d56184ad91dc486756da2df61c94d3e4e8d5ecb68"),
    ("GPL-3.0", "ac6b52d57c0104e687039148f7b8e370e04c9bb5705bb786f8ef814eb65e8636"),
    ("GPL-3.0", "092a7f3b82e6c22949b46388bca99e725b6e756f1c2b1e3f575447fbd44b6191"),
    ("LGPL-2.0", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("LGPL-2.0", "504542bce5421b0f5a7e63ddb55443ccb300b27a65ba6bfc1370fed16a3af260"),
    ("LGPL-2.0", "430627da7218a92ab4a6d75d5140cdb70ee750be7a53f913299b37e0d1b0eea2"),
    ("LGPL-2.1", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-2.1", "48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4"),
    ("LGPL-2.1", "bf2f0c6bf1c47b3b1e3cbedeefecddd1e7db21d1919858d45c2f918efaf426df"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "3f0343dd4f3b064be36e0c6584737c9b7bb5c322721694563f9009e088ce96d1"),
    ("MPL-2.0", "6fedd8db6adb0e102fc0f69b9e1501d2edaf25940e34910831cab46f9f5d4e4d"),
    ("GFDL-1.2", "1c057ea35084eb195331cec1a49fca335c176422a7726a9a23636906fd4e241f"),
    ("GFDL-1.3", "7e8edd3abe6258bb82bb853d91a0c24fcd9976894fd0592747354cffe1cb18e7"),
    ("GPL-1.0", "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224"),
    ("GPL-1.0", "6375a768fd262bf5281905a9585411d2d0fb4ea15cb08cfcba49f73fedb82abc"),
    ("GPL-1.0", "89f75ffda938e788be38679f9f83e317c2a03398fccf03ee60505d44d1bf9f70"),
    ("Artistic-1.0-Perl", "e963bc30f4d3c45f45030c34409ee37315564625649c1394e32bb5ddd99e01b2"),
]
SPELLINGS = [("licence", "license"), ("sub license", "sublicense"), ("non commercial", "noncommercial"), ("non infringement", "noninfringement"), ("merchantibility", "merchantability"), ("acknowledgement", "acknowledgment"), ("copyright owner", "copyright holder"), ("favour", "favor"), ("organisation", "organization"), ("fulfil ", "fulfill ")]
# What a copyright notice looks like, after lower-casing. A line of a licence's body may begin with the word
# by its wrapping, so a line counts only with a sign, a year or a year's blank after the word, or alone between blank lines.
NOTICE_LINE = r"(?m)^[ \t#*;/%!>-]*(?:copyright[ \t]*(?:\(c\)|©|,?[ \t]*(?:19|20)[0-9][0-9]|[<\[{(]y)|©|\(c\)[ \t]*(?:copyright|(?:19|20)[0-9][0-9])|all rights reserved[. \t\r]*$)[^\n]*$"
NOTICE_PARAGRAPH = r"(^|\n[ \t\r]*\n)[ \t#*;/%!>-]*copyright[^\n]*(\n[ \t\r]*\n|\n?\z)"


def canonical(text: Column) -> Column:
    out = F.regexp_replace(F.lower(text), NOTICE_LINE, " ")
    out = F.regexp_replace(out, NOTICE_PARAGRAPH, "\n\n")
    out = F.regexp_replace(out, r"[^\p{L}\p{N}]+", " ")
    for old, new in SPELLINGS:
        out = F.replace(out, F.lit(old), F.lit(new))
    return F.trim(out)


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_digests(spark: SparkSession, more: DataFrame | None = None) -> DataFrame:
    """digest and license_id of the fixed table and of `more` (license_id, body), one row a digest."""
    known = spark.createDataFrame(KNOWN, "license_id string, body string").select(digest(F.col("body")).alias("digest"), "license_id")
    known = known.unionByName(spark.createDataFrame(KNOWN_DIGESTS, "license_id string, digest string"))
    if more is not None:
        known = known.unionByName(more.select(digest(F.col("body")).alias("digest"), "license_id"))
    return known.groupBy("digest").agg(F.min("license_id").alias("license_id"))


def scan_licenses(docs: DataFrame, text: str = "text", more: DataFrame | None = None) -> DataFrame:
    """docs with digest (of the canonical form of the whole text) and license_id, null where no licence has it."""
    rows = docs.drop("digest", "license_id").withColumn("digest", digest(text_or_empty(text)))
    known = known_digests(docs.sparkSession, more)
    return rows.join(F.broadcast(known) if more is None else known, "digest", "left")


def scan_notices(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, line (from 0), license_id: the lines that are, as a whole, a known licence text or notice."""
    lines = docs.select("doc_id", F.posexplode(F.split(text_or_empty(text), "\n")).alias("line", "body")).filter(F.col("body").rlike("(?i)licen[cs]e"))
    return lines.withColumn("digest", digest(F.col("body"))).join(F.broadcast(known_digests(docs.sparkSession)), "digest").select("doc_id", "line", "license_id")


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return found.select("doc_id", "digest", "license_id")


def _sql_canonical(text: str) -> str:
    out = f"regexp_replace(lower({text}), '{NOTICE_LINE}', ' ', 'g')"
    out = f"regexp_replace({out}, '{NOTICE_PARAGRAPH}', chr(10) || chr(10), 'g')"
    out = f"regexp_replace({out}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')"
    for old, new in SPELLINGS:
        out = f"replace({out}, '{old}', '{new}')"
    return f"sha256(trim({out}))"


def _sql_known() -> str:
    rows = ", ".join("('{}', '{}')".format(name, body.replace("'", "''")) for name, body in KNOWN)
    digests = ", ".join(f"('{name}', '{d}')" for name, d in KNOWN_DIGESTS)
    return f"SELECT digest, min(license_id) AS license_id FROM (SELECT {_sql_canonical('body')} AS digest, license_id FROM (VALUES {rows}) v(license_id, body) UNION ALL SELECT digest, license_id FROM (VALUES {digests}) w(license_id, digest)) GROUP BY 1"


OP2_SQL = f"WITH known AS ({_sql_known()}), d AS (SELECT doc_id, {_sql_canonical('coalesce(text, chr(0)[2:])')} AS digest FROM documents) SELECT d.doc_id, d.digest, known.license_id FROM d LEFT JOIN known USING (digest)".replace("chr(0)[2:]", "''")
