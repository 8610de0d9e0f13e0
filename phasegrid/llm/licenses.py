"""License scans by canonical digest lookup.

A text is made canonical: lower case, copyright lines dropped, equivalent spellings merged,
punctuation and runs of white space replaced by one space. Its SHA-256 is looked up among the
digests of known texts, so two texts match only as wholes. Scanned are the entire document and each
of its lines taken as an entire text, which finds notices that stand in a document.

The table of known texts is a parameter. The default, ``KNOWN``, has the complete texts in
``license_texts`` as their copies have them, their titles, SPDX lines, headers and telling lines. It is broadcast while it has ``max_broadcast`` rows or
fewer (a digest row is under 200 bytes); a larger one is joined by a shuffle on the digest, where
AQE splits a frequent one. Equal lines of a document are merged before the join.

Null texts count as empty and match nothing, as do texts that are empty once canonical. A text of any
length is read whole. Of several licences with one canonical text the least id is given. Repeated ids
are told apart by their text; rows equal in both give one row. An empty table gives an empty result.
Extra columns are ignored.
"""

from __future__ import annotations

import re
import textwrap
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from phasegrid.llm.shared import text_or_empty

#: Fixed values: (found, merged into), on lower-case text.
SPELLINGS = (
    ("licence", "license"),
    ("sub-licen", "sublicen"),
    ("non-commercial", "noncommercial"),
    ("https://", "http://"),
    ("&", " and "),
)
COPYRIGHT_LINE = r"(?m)^[^a-z0-9\n]*(copyright|\(c\)|©)[^\n]*$"

#: Fixed values: (license id, one-sentence notice).
NOTICES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("ISC", "Released under the ISC License."),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
    ),
)

#: Titles by license id; a whole text is known under each of them and without one.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"),
    "ISC": ("ISC License", "The ISC License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", "New BSD License"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD"),
    "Zlib": ("zlib License", "The zlib License"),
    "Unlicense": ("The Unlicense",),
}
#: What the copies of a text differ in, (pattern, replacement).
VARIANTS = {
    "Apache-2.0": ((r"(?s)(END OF TERMS AND CONDITIONS).*", r"\1"), (r"(?s)\s*END OF TERMS AND CONDITIONS.*", "")),
    "GPL-2.0": (
        (r"51 Franklin Street, Fifth Floor, Boston, MA 02110-1301,? USA", "59 Temple Place, Suite 330, Boston, MA  02111-1307  USA"),
        (r"(?s)(END OF TERMS AND CONDITIONS).*", r"\1"),
    ),
    "GPL-3.0": ((r"(?s)(END OF TERMS AND CONDITIONS).*", r"\1"),),
    "LGPL-2.1": ((r"(?s)(END OF TERMS AND CONDITIONS).*", r"\1"),),
    "BSD-2-Clause": ((r"(?m)^\d\. ", ""),),
    "BSD-3-Clause": ((r"(?m)^\d\. ", ""), (r"the copyright holder nor", "the author nor"), (r"the copyright holder nor", "the University nor")),
}
#: Lines that only licenses of one family share bear its name.
FAMILIES = {"BSD-2-Clause": "BSD", "BSD-3-Clause": "BSD"} | dict.fromkeys(("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0"), "GNU")
IDENTIFIERS = {x: (f"{x}-only", f"{x}-or-later", f"{x}+") for x in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0")}
#: A line of a text is a notice by itself if it has so many characters.
LINE_CHARS = 40
#: Shorter texts are known as wrapped at each of these widths.
WRAPPED_CHARS, WIDTHS = 5_000, range(60, 101)


def _without_copyright(lines: list[str]) -> str:
    """One line: line breaks matter only where a line begins like a copyright line and is dropped."""
    return " ".join(" ".join(x for x in lines if not re.match(COPYRIGHT_LINE, x.lower())).split())


def _paragraphs(text: str) -> list[str]:
    return [" ".join(p.split()) for p in re.split(r"\n[ \t\f]*\n|\n(?=[ \t]*(?:\d+\.|\*)[ \t])", text) if p.strip()]


def _wholes(license_id: str, text: str) -> set[str]:
    """The text as its copies have it: with and without title, appendix and numbers, wrapped anew."""
    made = [text, *[re.sub(found, put, text) for found, put in VARIANTS.get(license_id, ())]]
    out = set()
    for body in made:
        paragraphs = _paragraphs(body)
        wrapped = {_without_copyright(body.split("\n")), _without_copyright(paragraphs)}
        for width in WIDTHS if len(body) < WRAPPED_CHARS else ():
            wrapped.add(_without_copyright([line for p in paragraphs for line in textwrap.wrap(p, width)]))
        reserved = ("", "All rights reserved. ") if len(body) < WRAPPED_CHARS else ("",)
        heads = ("", *[f"{t} " for t in TITLES.get(license_id, ())])
        out |= {h + r + w for h in heads for r in reserved for w in wrapped}
    return out


def _known() -> tuple[tuple[str, str], ...]:
    """Notices, titles, SPDX lines, whole texts, and the lines and paragraphs that tell a license.

    A line of several licenses bears the name of their family, or is left out if they have none."""
    texts = {p.stem: p.read_text(encoding="utf-8") for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))}
    out = list(NOTICES)
    for license_id, text in texts.items():
        out += [(license_id, t) for t in TITLES.get(license_id, ())]
        out += [(license_id, f"SPDX-License-Identifier: {x}") for x in (license_id, *IDENTIFIERS.get(license_id, ()))]
        out += [(license_id, whole) for whole in sorted(_wholes(license_id, text))]
    owners: dict[str, tuple[str, set[str]]] = {}
    for license_id, text in texts.items():
        for line in [*text.split("\n"), *_paragraphs(text)]:
            plain = " ".join(re.findall(r"[^\W_]+", line.lower()))
            if len(plain) >= LINE_CHARS and not re.match(COPYRIGHT_LINE, line.lower()):
                owners.setdefault(plain, (line, set()))[1].add(license_id)
    wholes = {" ".join(re.findall(r"[^\W_]+", text.lower())) for _, text in out}
    for plain, (line, ids) in owners.items():
        names = ids if len(ids) == 1 else {FAMILIES.get(x) for x in ids}
        if len(names) == 1 and None not in names and plain not in wholes:
            out.append((names.pop(), line.strip()))
    return tuple(out)


#: (license id, entire text): the default table. A caller may pass its own.
KNOWN = _known()


def canonical(text: Column) -> Column:
    """Canonical form that keeps line feeds, so it can be taken of a document and then split."""
    out = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, "")
    for found, merged in SPELLINGS:
        out = F.replace(out, F.lit(found), F.lit(merged))
    out = F.regexp_replace(out, r"[!-/:-@\[-`{-~ \t\r\f]+", " ")
    return F.regexp_replace(out, r"(?m)^ | $", "")


def one_line(canonical_text: Column) -> Column:
    return F.trim(F.regexp_replace(canonical_text, r"[ \n]+", " "))


def known_licenses(spark: SparkSession, known: tuple[tuple[str, str], ...] = KNOWN) -> DataFrame:
    return spark.createDataFrame(list(known), "license_id string, text string")


def license_digests(known: DataFrame) -> DataFrame:
    """(digest, license_id); of several ids with one canonical text the smallest."""
    made = known.select("license_id", one_line(canonical(F.col("text"))).alias("c")).where("c <> ''")
    return made.groupBy(F.sha2("c", 256).alias("digest")).agg(F.min("license_id").alias("license_id"))


def license_scan(docs: DataFrame, known: DataFrame, max_broadcast: int = 100_000) -> DataFrame:
    """One row per document that holds a known text: doc_id, license_id (of the whole text, else
    null), notices (sorted ids of its lines), n_notices, canonical_sha256."""
    digests = license_digests(known)
    if digests.count() <= max_broadcast:
        digests = F.broadcast(digests)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), canonical(text_or_empty()).alias("c"))
    lines = F.array_distinct(F.filter(F.split("c", "\n"), lambda x: x != ""))
    base = base.select("doc_id", one_line(F.col("c")).alias("whole"), lines.alias("lines"))
    # One reading of each text: the document and its lines are units of one table.
    digest = F.transform(F.concat(F.array("whole"), "lines"), lambda text: F.sha2(text, 256))
    units = base.select("doc_id", F.sha2("whole", 256).alias("whole"), F.posexplode(digest).alias("place", "digest"))
    known_unit = units.join(digests, "digest")
    found = known_unit.groupBy("doc_id", "whole").agg(
        F.max(F.when(F.col("place") == 0, F.col("license_id"))).alias("license_id"),
        F.sort_array(F.collect_set(F.when(F.col("place") > 0, F.col("license_id")))).alias("notices"),
    )
    return found.select(
        "doc_id", "license_id", F.array_join("notices", ",").alias("notices"), F.size("notices").cast("long").alias("n_notices"),
        F.col("whole").alias("canonical_sha256"),
    )
