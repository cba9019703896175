"""License scans: ordered signature rules, gated by keywords, with overlapping detections resolved by priority and containment.

DataFrame functions only.  A text becomes a line of words, each with a blank on both sides, so that rules are regexes over
whole words: "licensed under" is ` licensed  under `.  Only texts that hold an anchor keyword get that far; of the rules, only those of
families whose keywords a text holds are tried.  Matches are placed by what lies between them, counted in words.  A
detection within another one of a stronger priority, or of the same priority and longer, is suppressed.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from concord.llm.common import materialise

BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: How strongly a detection is believed, by priority; 0 are the phrases that are asked for.
BELIEF = (1.0, 0.98, 0.9, 0.7, 0.5)

#: Signatures.  A blank parts words, ~ makes a word optional, the rest is a regex of a word.
#: label: keywords, names, versions
FAMILIES = {
    "gpl": (("gnu", "gpl"), ("~gnu gpl", "gnu ~gpl general public licen[sc]e"), ("1.0", "2.0", "3.0")),
    "lgpl": (("gnu", "lgpl"), ("~gnu lgpl", "gnu (?:lesser|library) general public licen[sc]e"), ("2.0", "2.1", "3.0")),
    "agpl": (("gnu", "agpl"), ("~gnu agpl", "gnu affero general public licen[sc]e"), ("1.0", "3.0")),
    "gfdl": (("gnu", "gfdl"), ("~gnu gfdl", "gnu free documentation licen[sc]e"), ("1.1", "1.2", "1.3")),
    "apache": (("apache",), ("apache ~software licen[sc]e",), ("1.0", "1.1", "2.0")),
    "mpl": (("mozilla", "mpl"), ("mpl", "mozilla public licen[sc]e"), ("1.0", "1.1", "2.0")),
    "epl": (("eclipse",), ("eclipse public licen[sc]e",), ("1.0", "2.0")),
    "eupl": (("european",), ("european union public licen[sc]e",), ("1.0", "1.1", "1.2")),
    "cddl": (("development",), ("common development and distribution licen[sc]e",), ("1.0", "1.1")),
    "cpl": (("common",), ("common public licen[sc]e",), ("1.0",)),
    "ofl": (("font",), ("~sil open font licen[sc]e",), ("1.0", "1.1")),
    "artistic": (("artistic",), ("artistic licen[sc]e",), ("1.0", "2.0")),
    "zpl": (("zope",), ("zope public licen[sc]e",), ("1.1", "2.0", "2.1")),
    "lppl": (("latex",), ("latex project public licen[sc]e",), ("1.0", "1.2", "1.3")),
    "bsl": (("boost",), ("boost software licen[sc]e",), ("1.0",)),
    "osl": (("open",), ("open software licen[sc]e",), ("1.0", "2.0", "3.0")),
    "afl": (("academic",), ("academic free licen[sc]e",), ("1.2", "2.0", "3.0")),
    "odbl": (("database",), ("open ~data database licen[sc]e", "open data commons open database licen[sc]e"), ("1.0",)),
    "mit": (("mit",), ("mit x11? ~style licen[sc]e", "mit ~style licen[sc]e", "mit public licen[sc]e"), ()),
    "bsd-2-clause": (("bsd",), ("bsd (?:2|two) clause ~licen[sc]e", "simplified bsd licen[sc]e", "freebsd licen[sc]e"), ()),
    "bsd-3-clause": (("bsd",), ("bsd (?:3|three) clause ~licen[sc]e", "(?:new|revised|modified) bsd licen[sc]e"), ()),
    "bsd-4-clause": (("bsd",), ("bsd (?:4|four) clause ~licen[sc]e", "(?:original|old) bsd licen[sc]e"), ()),
    "bsd": (("bsd",), ("bsd ~style licen[sc]e",), ()),
    "isc": (("isc",), ("isc licen[sc]e",), ()),
    "zlib": (("zlib",), ("zlib ~libpng licen[sc]e",), ()),
    "unlicense": (("unlicen",), ("the unlicen[sc]e",), ()),
    "wtfpl": (("what",), ("do what the fuck you want to public licen[sc]e",), ()),
    "ms-pl": (("microsoft",), ("microsoft public licen[sc]e",), ()),
    "ms-rl": (("microsoft",), ("microsoft reciprocal licen[sc]e",), ()),
    "psf": (("python",), ("python software foundation licen[sc]e", "psf licen[sc]e"), ()),
    "postgresql": (("postgresql",), ("postgresql licen[sc]e",), ()),
    "ncsa": (("ncsa",), ("~university ~of ~illinois ncsa ~open ~source licen[sc]e",), ()),
    "proprietary": (("reserved",), ("all rights reserved", "proprietary ~and confidential ~all ~rights reserved"), ()),
    "public-domain": (("domain",), ("(?:in|into|to) the public domain", "public domain ~dedication"), ()),
    "cc0": (("cc0",), ("~cc cc0 ~licen[sc]e", "cc0 1 0 ~universal", "creative commons zero"), ()),
}
#: Elements of the Creative Commons licenses: id, short words, long words.
COMMONS = (
    ("by", "by", "attribution"),
    ("by-sa", "by sa", "attribution share ~alike"),
    ("by-nd", "by nd", "attribution no ~deriv(?:s|atives|ative)"),
    ("by-nc", "by nc", "attribution non ~commercial"),
    ("by-nc-sa", "by nc sa", "attribution non ~commercial share ~alike"),
    ("by-nc-nd", "by nc nd", "attribution non ~commercial no ~deriv(?:s|atives|ative)"),
)
COMMONS_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
GRANT = "(?:licensed|released|distributed|available|published|provided|covered) under ~the ~terms ~of ~the ~conditions ~of ~an? "
LATER = " or ~(?:at|any) ~your ~option ~any (?:later|newer|greater|above) ~versions?"
#: What a text must hold for any rule to be tried.
ANCHORS = ("licen", "copyright", "gpl", "creative", "reserved", "domain", "cc0", "cc-by", "cc by")


def signature(words: str) -> str:
    """The regex of a signature over a line of words."""
    parts = [f"(?: (?:{w[1:]}) )?" if w.startswith("~") else f" (?:{w}) " for w in words.split()]
    return "".join(parts)


def versions(version: str) -> list[str]:
    """How a version is written: version 3.0, v3.0, 3.0, v 3, 3."""
    major, minor = version.split(".")
    small = f"~{minor}" if minor == "0" else minor
    return [f"~(?:version|ver|v|licen[sc]e) ~(?:version|v) v?{major} {small}"]


@dataclass(frozen=True)
class Rule:
    """priority: lower is stronger.  keywords: all must be in a text.  width: words of a detection where the regex only takes the first."""

    label: str
    priority: int
    keywords: tuple[str, ...]
    regex: str
    width: int = 0


def commons_rules() -> Iterator[Rule]:
    for element, short, long in COMMONS:
        long = long.replace("share ~alike", "share?(?:alike)? ~alike").replace("non ~commercial", "non(?:commercial)? ~commercial").replace("no ~deriv", "no(?:deriv(?:s|atives|ative))? ~deriv")
        for v in COMMONS_VERSIONS:
            number = " ".join(["~(?:version|v|licen[sc]e)", *v.split(".")])
            yield Rule(f"cc-{element}-{v}", 1, ("spdx",), signature(f"spdx license identifier cc {short} {' '.join(v.split('.'))}"))
            yield Rule(f"cc-{element}-{v}", 2, ("cc",), signature(f"{GRANT}cc {short} {number}"))
            yield Rule(f"cc-{element}-{v}", 3, ("cc",), signature(f"cc {short} {number}"))
            yield Rule(f"cc-{element}-{v}", 3, ("creative",), signature(f"creative commons {long} {number}"))
        yield Rule(f"cc-{element}", 4, ("cc",), signature(f"cc {short}"))
        yield Rule(f"cc-{element}", 4, ("creative",), signature(f"creative commons {long}"))


def method_rules() -> list[Rule]:
    """The signatures of all families, each by itself, after a grant, with its versions, and as an SPDX tag."""
    out = []
    for family, (keys, names, numbers) in FAMILIES.items():
        out.append(Rule(family, 1, ("spdx",), signature(f"spdx license identifier {family.replace('-', ' ')}")))
        for name in names:
            key = next((k for k in keys if k in name), keys[0])
            for v in numbers:
                for number in versions(v):
                    out.append(Rule(f"{family}-{v}-or-later", 2, (key, "later"), signature(f"{name} {number}{LATER}")))
                    out.append(Rule(f"{family}-{v}", 2, (key, "under"), signature(f"{GRANT}{name} {number}")))
                    out.append(Rule(f"{family}-{v}", 3, (key,), signature(f"{name} {number}")))
            out.append(Rule(family, 3 if not numbers else 4, (key, "under"), signature(GRANT + name)))
            out.append(Rule(family, 4, (key,), signature(name)))
        for v in numbers:
            tag = f"spdx license identifier {family} {' '.join(v.split('.'))}"
            out.append(Rule(f"{family}-{v}-or-later", 1, ("spdx",), signature(f"{tag} or later")))
            out.append(Rule(f"{family}-{v}", 1, ("spdx",), signature(f"{tag} ~only")))
    return [*out, *commons_rules()]


#: Phrases whose places are counted, by label.
PHRASES = {"mit": ("under the mit license",), "apache-2": ("apache license version 2",), "cc-by-nc": ("cc by nc",)}


def phrase_rule(label: str, phrase: str) -> Rule:
    """Every place of a phrase, overlapping ones too: its first word, with the others ahead."""
    words = phrase.split()
    ahead = "".join(f" {w} " for w in words[1:])
    return Rule(label, 0, tuple(dict.fromkeys(words)), f" {words[0]} (?={ahead})" if ahead else f" {words[0]} ", len(words))


def let(value: Column, body) -> Column:
    """body(value) with value evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_in(part: Column) -> Column:
    """How many words a part of a line of words holds: each has a blank on both sides."""
    return ((F.length(part) - F.length(F.replace(part, F.lit(" "), F.lit("")))) / 2).cast("int")


@dataclass(frozen=True)
class LicenseScan:
    """phrases: words, parted by blanks, whose places are counted, by label.  rules: the signatures besides, None for the own ones."""

    phrases: tuple[tuple[str, str], ...] = tuple((label, p) for label, ps in PHRASES.items() for p in ps)
    rules: tuple[Rule, ...] | None = None

    def all_rules(self) -> list[Rule]:
        return [*(phrase_rule(*p) for p in self.phrases), *(method_rules() if self.rules is None else self.rules)]

    def line(self, text: Column) -> Column:
        """The words of a text, each with a blank on both sides; empty without words."""
        words = F.trim(F.regexp_replace(F.translate(text, UPPER, LOWER), BETWEEN, "  "))
        return F.when(words == "", "").otherwise(F.concat(F.lit(" "), words, F.lit(" ")))

    def promising(self, text: Column) -> Column:
        """Whether any rule may match: an anchor is there, or a phrase."""
        lower = F.lower(text)
        may = F.lit(False)
        for anchor in ANCHORS if self.rules is None else sorted({r.keywords[0] for r in self.rules}):
            may = may | F.contains(lower, F.lit(anchor))
        for _, phrase in self.phrases:
            words = list(dict.fromkeys(phrase.split()))
            held = F.lit(True)
            for w in words:
                held = held & F.contains(lower, F.lit(w))
            may = may | (held & F.rlike(lower, F.lit(BETWEEN.join(phrase.split()))))
        return F.coalesce(may, F.lit(False))

    def detections(self, line: Column) -> Column:
        """array of (rule, label, priority, width, gaps, widths): the rules that match, with the words between and in their matches."""
        families: dict[tuple[str, ...], list[dict]] = {}
        for i, r in enumerate(self.all_rules()):
            families.setdefault(r.keywords, []).append({"rule": i, "label": r.label, "priority": r.priority, "width": r.width, "regex": r.regex})
        table = json.dumps([{"keywords": list(k), "rules": v} for k, v in families.items()])
        known = F.from_json(F.lit(table), "array<struct<keywords: array<string>, rules: array<struct<rule: int, label: string, priority: int, width: int, regex: string>>>>")
        gated = F.flatten(F.transform(F.filter(known, lambda f: F.forall(f["keywords"], lambda k: F.contains(line, k))), lambda f: f["rules"]))
        matching = F.filter(gated, lambda r: F.rlike(line, r["regex"]))
        return F.transform(
            matching,
            lambda r: F.struct(
                r["rule"].alias("rule"), r["label"].alias("label"), r["priority"].alias("priority"), r["width"].alias("width"),
                F.transform(F.split(line, r["regex"], -1), words_in).alias("gaps"), F.transform(F.regexp_extract_all(line, r["regex"], F.lit(0)), words_in).alias("widths"),
            ),
        )

    def placed(self, found: DataFrame) -> DataFrame:
        """(rid, rule, label, priority, start, end) of every match, in words from 0."""
        one = found.select("rid", F.explode("found").alias("f")).select("rid", "f.rule", "f.label", "f.priority", "f.width", F.posexplode(F.arrays_zip("f.gaps", "f.widths")).alias("pos", "part"))
        so_far = W.partitionBy("rid", "rule").orderBy("pos")
        start = F.sum("part.gaps").over(so_far) + F.coalesce(F.sum("part.widths").over(so_far.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        spots = one.withColumn("start", start).where("part.widths is not null")
        return spots.select("rid", "rule", "label", "priority", "start", (F.col("start") + F.when(F.col("width") > 0, F.col("width")).otherwise(F.col("part.widths"))).alias("end"))

    def kept(self, spots: DataFrame) -> DataFrame:
        """Without detections that lie within one of a stronger priority, or of the same and longer, or equal and of an earlier rule;
        whatever may hold a detection comes before it in the order of the window.  Phrases stay."""
        before = W.partitionBy("rid").orderBy("start", F.desc("end"), "priority", "rule").rowsBetween(W.unboundedPreceding, -1)
        reach = F.lit(None).cast("long")
        for p in reversed(range(len(BELIEF))):
            reach = F.when(F.col("priority") == p, F.max(F.when(F.col("priority") <= p, F.col("end"))).over(before)).otherwise(reach)
        return spots.withColumn("reach", reach).where("priority = 0 or reach is null or reach < end").drop("reach")

    def apply(self, docs: DataFrame) -> DataFrame:
        """Per row of `docs` (doc_id, text): doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

        n_base: places of the phrases; first_word, last_word: the smallest and largest of their starts, null if none.  base_labels:
        the phrases' labels; labels: those of the rules' detections too; both distinct, sorted, joined by commas, empty if none.  score: belief in
        the strongest detection left, 0 if none.  Null and wordless texts have 0 words and nothing found.  Repeated rows are judged
        alike, each for itself; doc_id may be null or shared.  Other columns are ignored.
        """
        found = F.when(self.promising(F.col("text")), let(self.line(F.col("text")), self.detections))
        every = docs.select("doc_id", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("n_words"), found.alias("found"), F.monotonically_increasing_id().alias("rid"))
        every = materialise(every, "found")
        base = F.col("priority") == 0
        joined = lambda label: F.array_join(F.array_sort(F.collect_set(label)), ",")
        belief = F.element_at(F.array(*map(F.lit, BELIEF)), F.col("priority") + 1)
        told = self.kept(self.placed(every.where(F.size("found") > 0))).groupBy("rid").agg(
            F.count(F.when(base, 1)).alias("n_base"), F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"), F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
            joined(F.when(base, F.col("label"))).alias("base_labels"), joined(F.col("label")).alias("labels"), F.max(belief).alias("score"),
        )
        columns = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
        nothing = {"n_base": F.lit(0).cast("long"), "first_word": F.lit(None).cast("long"), "last_word": F.lit(None).cast("long"), "base_labels": F.lit(""), "labels": F.lit(""), "score": F.lit(0.0)}
        without = every.where("found is null or size(found) = 0").withColumns(nothing)
        return every.where(F.size("found") > 0).select("rid", "doc_id", "n_words").join(told, "rid").select(*columns).unionByName(without.select(*columns))
