"""Text cleaning whose every finding has exact raw positions, and whose changes are reversible patches.

A finding is patched (its replacement goes into the cleaned text), kept or flagged. Spark has no function that gives all positions of a
pattern, so one Arrow pass looks at each whole text and returns its findings and its cleaned text together; all that
follows is DataFrame work on findings.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.batches import bound_batches, tidy
from lectern.functions.scalars import TITLE_NUMBER
from lectern.operators.spans import apply_patches, patches_from

# Kinds of findings, what is done about them, how they end, and the patterns that define them.
KINDS = ("encoding_issue", "replacement_char", "private_use_area", "control_char", "escape_residue", "watermark", "header_footer", "duplicate", "missing", "textualized_diagram", "suspected_error", "variant_mixed")
PATCHED = ("encoding_issue", "control_char", "escape_residue", "watermark", "header_footer")
KEPT = ("replacement_char", "private_use_area", "variant_mixed")
STATES = {"replacement_char": "known_unresolvable", "private_use_area": "known_unresolvable", "missing": "deferred", "suspected_error": "deferred"}
PATTERNS = {
    "encoding_issue": r"\ufeff|<!--\s*coding:[^>]+-->|#\s*-\*-\s*coding:[^\n]+",
    "replacement_char": r"[\?□\ufffd]",
    "private_use_area": r"[\ue000-\uf8ff\U000f0000-\U000ffffd\U00100000-\U0010fffd]",
    "control_char": r"[\u200b\u200c\u200d\x00-\x08\x0b\x0e-\x1f]",
    "escape_residue": r"\\[\-\[\]\*\_\\]",
    "watermark": r"https?://[^\s]+|www\.[^\s]+|殆知阁整理|本电子书由[^\s\n]+提供|下载自[^\s\n]+|扫校[：:][^\s\n]+|扫描制作[：:][^\s\n]+",
    "header_footer": r"---\s*第\s*\d+\s*页\s*---|===+\s*.*?\s*===+|【第\s*[0-9一二三四五六七八九十]+\s*页】",
    "textualized_diagram": r"【图(?:表|式)?(?:：.*?)?】|\[图(?:表|式)?(?:：.*?)?\]|\|(?:\s*---\s*\|)+",
    "duplicate": r"([^\s，。！？、]{4,})\1+",
    "missing": r"【缺(?:字|失)?】|\[缺(?:字|失)?\]|〔阙〕",
}
#: One of these is in whatever the pattern finds; a text without them isn't searched.
MARKS = {
    "encoding_issue": ("\ufeff", "<!--", "#"), "replacement_char": ("?", "□", "\ufffd"), "escape_residue": ("\\",), "watermark": ("http", "www.", "殆知阁整理", "本电子书由", "下载自", "扫校", "扫描制作"),
    "header_footer": ("---", "===", "【第"), "textualized_diagram": ("【图", "[图", "|"), "missing": ("【缺", "[缺", "〔阙〕"),
}
#: Kinds that nothing but their pattern finds (lines that come often are no marks, nor are titles); front matter has its own mark.
MARKED = frozenset(MARKS) - {"header_footer", "textualized_diagram", "missing"}
FRONT_MATTER = r"\A---[ \t]*\r?\n.*?\r?\n---[ \t]*(?:\r?\n|\Z)"
BOX_MARKS = "┌┐└┘├┤┬┴┼─│━┃┏┓┗┛═║╔╗╚╝╠╣╦╩╬+-—―|"
CONTENTS_HEAD = r"(?:^|\n)[ \t]*(?:[^\n]{0,15})?(?:目錄|目录|卷目|目次)[ \t*：:\n]+"
LETTER = r"[A-Za-z\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff]"
CONTEXT, MARKS_IN_LINE, LINES_IN_BLOCK = 15, 3, 2

_RULE = {kind: re.compile(pattern) for kind, pattern in PATTERNS.items()}
_FRONT, _CONTENTS, _NUMBER, _LETTER = re.compile(FRONT_MATTER, re.DOTALL), re.compile(CONTENTS_HEAD), re.compile(TITLE_NUMBER), re.compile(LETTER)
_DRAWN = re.compile(rf"(?:[^{re.escape(BOX_MARKS)}]*[{re.escape(BOX_MARKS)}]){{{MARKS_IN_LINE}}}")
#: Lines made of drawing marks, or framed by them, in blocks of two or more.
_BLOCK = re.compile(rf"(?:^[ \t]*[{re.escape(BOX_MARKS)}]{{3,}}[ \t]*$\n?){{2,}}|(?:^[ \t]*[┌│├└+|║][^\n]*[┐│┤┘+|║][ \t]*$\n?){{2,}}|(?:[|+][\-+|=—―]{{3,}}[|+]\n?){{2,}}", re.MULTILINE)
#: A block has four marks at least, and begins with its line or with one of two marks.
_MARK, _BLOCK_HEAD, LEAST_MARKS = re.compile(rf"[{re.escape(BOX_MARKS)}]"), re.compile(rf"\n[ \t]*[{re.escape(BOX_MARKS)}]|\||\+"), 4
#: A phrase that follows itself has so many characters, and lies in a stretch without spaces and stops.
PHRASE, SHORT = 4, 64
_STRETCH = re.compile(rf"[^\s，。！？、]{{{2 * PHRASE},}}")
#: In short words, the first characters of a phrase are looked for again by this; it would take the square of a long one.
_AGAIN = re.compile(rf"(.{{{PHRASE}}}).*\1", re.DOTALL)


class Finding(NamedTuple):
    kind: str
    action: str
    raw_start: int
    raw_end: int
    excerpt: str
    context: str
    replacement: str
    terminal_state: str


class Cover:
    """Intervals sorted once. ``holds``: their union has a whole interval; ``within``: a single one has it."""

    def __init__(self, intervals: Iterable[tuple[int, int]]):
        self.begins, self.furthest = [], []
        self.blocks, self.ends = [], []
        for a, b in sorted(intervals):
            self.begins.append(a)
            self.furthest.append(max(b, self.furthest[-1]) if self.furthest else b)
            if self.ends and a <= self.ends[-1]:
                self.ends[-1] = max(b, self.ends[-1])
            else:
                self.blocks.append(a)
                self.ends.append(b)

    def holds(self, start: int, end: int) -> bool:
        at = bisect_right(self.blocks, start) - 1
        return start >= end or (at >= 0 and end <= self.ends[at])

    def within(self, start: int, end: int) -> bool:
        at = bisect_right(self.begins, start) - 1
        return at >= 0 and end <= self.furthest[at]


class Sight:
    """One text with its findings so far. Front matter is hidden from every rule but its own."""

    def __init__(self, raw: str):
        self.raw, self.found = raw, defaultdict(dict)
        head = _FRONT.match(raw)
        self.front = head.end() if head else 0
        self.text = re.sub(r"[^\n]", " ", raw[: self.front]) + raw[self.front :] if head else raw
        # Lines with their starts, and their ends without the line break.
        self.lines, at = [], 0
        for line in self.text.splitlines(keepends=True):
            self.lines.append((at, at + len(line.rstrip("\r\n")), line))
            at += len(line)

    def note(self, kind: str, start: int, end: int) -> None:
        self.found[kind].setdefault((start, end), True)

    def cover(self, *kinds: str) -> Cover:
        """What the findings of some kinds hold so far."""
        return Cover(place for k in kinds for place in self.found[k])

    def starts(self, kind: str) -> set[int]:
        return {a for a, _ in self.found[kind]}

    def findings(self, kinds: Sequence[str]) -> list[Finding]:
        out = []
        for kind, places in self.found.items():
            if kind not in kinds:
                continue
            action = "patched" if kind in PATCHED else "kept" if kind in KEPT else "flagged"
            for start, end in places:
                excerpt = self.raw[start:end]
                escape = kind == "escape_residue" and end - start == 2 and excerpt[0] == "\\"
                context = self.raw[max(0, start - CONTEXT) : end + CONTEXT].replace("\n", " ")
                out.append(Finding(kind, action, start, end, excerpt, context, excerpt[1:] if escape else "" if action == "patched" else excerpt, STATES.get(kind, "processed")))
        return sorted(out, key=lambda f: (f.raw_start, f.raw_end, f.kind))


def _matches(kind: str, text: str) -> Iterable[re.Match]:
    return _RULE[kind].finditer(text) if any(m in text for m in MARKS.get(kind, ("",))) else ()


def _single_marks(sight: Sight) -> None:
    """Front matter, encoding marks, replacement and private characters, controls, escapes and provider lines."""
    if sight.front:
        sight.note("escape_residue", 0, sight.front)
    for kind in ("encoding_issue", "replacement_char", "private_use_area", "control_char", "escape_residue", "watermark"):
        for m in _matches(kind, sight.text):
            sight.note(kind, *m.span())


def _running_heads(sight: Sight) -> None:
    """Lines of 2 to 40 characters that come three times or more, and page marks."""
    often = Counter(s for _, _, line in sight.lines if 2 <= len(s := line.strip()) <= 40)
    for start, end, line in sight.lines:
        if often.get(line.strip(), 0) >= 3:
            sight.note("header_footer", start, end)
    begun = sight.starts("header_footer")
    for m in _matches("header_footer", sight.text):
        if m.start() not in begun:
            sight.note("header_footer", *m.span())


def _framed(text: str) -> Iterator[tuple[int, int]]:
    """The places of all blocks of framed lines; the pattern is tried only where one can begin."""
    at, found = 0, _BLOCK.match(text)
    while True:
        if found:
            yield found.span()
            at = found.end()
            found = _BLOCK.match(text, at)
            continue
        head = _BLOCK_HEAD.search(text, at)
        if not head:
            return
        start, at = head.start() + (text[head.start()] == "\n"), head.end()
        found = _BLOCK.match(text, start) or (_BLOCK.match(text, at - 1) if start < at - 1 else None)


def _diagrams(sight: Sight) -> None:
    """Marked diagrams, blocks of framed lines, and two or more lines with three drawing marks each."""
    for m in _matches("textualized_diagram", sight.text):
        sight.note("textualized_diagram", *m.span())
    if len(_MARK.findall(sight.text)) < LEAST_MARKS:
        return
    framed = list(_framed(sight.text))
    drawn, run = [], []
    for start, end, line in [*sight.lines, (0, 0, "")]:
        if _DRAWN.match(line):
            run.append((start, end))
        else:
            if len(run) >= LINES_IN_BLOCK:
                drawn.append((run[0][0], run[-1][1]))
            run = []
    # What lies inside an earlier finding is none of its own; blocks of either sort don't meet among themselves.
    for blocks in (framed, drawn):
        marked = sight.cover("textualized_diagram")
        for start, end in blocks:
            if not marked.within(start, end):
                sight.note("textualized_diagram", start, end)


def _echoes(s: str) -> Iterator[tuple[int, int, str]]:
    """Start, end and phrase of what the pattern of duplicates finds in a stretch: from the left, the longest phrase that follows itself, with all its repeats.

    A phrase can only follow itself where its first characters come again, so a stretch takes time in proportion to its length and to such places, not to its square.
    """
    heads = [s[i : i + PHRASE] for i in range(len(s) - PHRASE + 1)]
    if len(set(heads)) == len(heads):
        return
    places = defaultdict(list)
    for i, head in enumerate(heads):
        places[head].append(i)
    at = 0
    while at <= len(s) - 2 * PHRASE:
        spots, end = places[heads[at]], at + 1
        for n in range(bisect_right(spots, at + (len(s) - at) // 2) - 1, -1, -1):
            second = spots[n]
            if second < at + PHRASE:
                break
            if s.startswith(phrase := s[at:second], second):
                end = second
                while s.startswith(phrase, end):
                    end += len(phrase)
                yield at, end, phrase
                break
        at = end


def _phrases(text: str) -> Iterator[tuple[int, int, str]]:
    """The same of a whole text. Different words are looked at once, and only those that have something are located."""
    for word in {w for w in text.split() if len(w) >= 2 * PHRASE}:
        if len(word) <= SHORT and not _AGAIN.search(word):
            continue
        found = [(m.start() + a, m.start() + b, phrase) for m in _STRETCH.finditer(word) for a, b, phrase in _echoes(m[0])]
        at = text.find(word) if found else -1
        while at >= 0:
            end = at + len(word)
            if not text[at - 1 : at].strip() and not text[end : end + 1].strip():
                yield from ((at + a, at + b, phrase) for a, b, phrase in found)
                at = text.find(word, end)
            else:
                at = text.find(word, at + 1)


def _repeats(sight: Sight) -> None:
    """Every place of a paragraph of 8 characters or more that comes twice, and phrases that follow themselves."""
    places = defaultdict(list)
    for m in re.finditer(r"[^\n]+", sight.text):
        part = m[0].strip()
        if len(part) >= 8:
            start = m.start() + m[0].index(part)
            places[part].append((start, start + len(part)))
    other = sight.cover("escape_residue", "textualized_diagram")
    for spots in places.values():
        if len(spots) > 1:
            for start, end in spots:
                if not other.holds(start, end):
                    sight.note("duplicate", start, end)
    whole = sight.cover("duplicate")
    for start, end, phrase in _phrases(sight.text):
        if _LETTER.search(phrase) and not other.holds(start, end) and not whole.within(start, end):
            sight.note("duplicate", start, end)


#: A line of the body is longer than a title, a sentence longer than a few words, or says that the body begins; a title of that many characters is known again inside a line.
LONG_TITLE, LONG_SENTENCE, BODY_HEAD, TELLING_TITLE = 40, 15, "正文", 4


def _reads_like_body(line: str) -> bool:
    return line == BODY_HEAD or len(line) > (LONG_SENTENCE if "。" in line else LONG_TITLE)


class _Titles:
    """Titles seen so far: whether a line repeats one, or has a telling one in it."""

    def __init__(self) -> None:
        self.all, self.telling = set(), []

    def add(self, title: str) -> None:
        if title not in self.all:
            self.all.add(title)
            self.telling += [title] if len(title) >= TELLING_TITLE else []

    def known_in(self, line: str) -> bool:
        return line in self.all or any(t in line for t in self.telling)


def contents_entries(text: str) -> tuple[list[tuple[str, int, int]], int]:
    """Titles of a text's table of contents with their places, and where the body begins behind it.

    The table ends with an empty line, or before the first line that belongs to the body: one that reads like it, or repeats a title.
    """
    head = _CONTENTS.search(text) if "目" in text else None
    if not head:
        return [], len(text)
    entries, titles, at = [], _Titles(), head.end()
    for line in text[at:].splitlines(keepends=True):
        title, upto = line.strip(), at + len(line)
        if not title:
            if entries:
                return entries, upto
        elif entries and (_reads_like_body(title) or titles.known_in(title)):
            return entries, at
        else:
            start = at + line.index(title)
            entries.append((title, start, start + len(title)))
            titles.add(title)
        at = upto
    return entries, at


def _gaps(sight: Sight) -> None:
    """Titles of the table of contents that the body lacks, and explicit marks of gaps."""
    entries, begin = contents_entries(sight.text)
    body = sight.text[begin:] if entries else ""
    for title, start, end in entries:
        bare = _NUMBER.sub("", title).strip()
        if title not in body and (bare if len(bare) >= 2 else title) not in body:
            sight.note("missing", start, end)
    begun = sight.starts("missing")
    for m in _matches("missing", sight.text):
        if m.start() not in begun:
            sight.note("missing", *m.span())


#: What finds which kinds, in the order in which they look; repeats leave out what escapes and diagrams hold.
_RULES = (
    (_single_marks, ("escape_residue", "encoding_issue", "replacement_char", "private_use_area", "control_char", "watermark", "duplicate")), (_running_heads, ("header_footer",)),
    (_diagrams, ("textualized_diagram", "duplicate")), (_repeats, ("duplicate",)), (_gaps, ("missing",)),
)


def examine(raw: str | None, variants: Mapping[str, str] = {}, suspects: Iterable[str] = (), kinds: Sequence[str] = KINDS) -> list[Finding]:  # noqa: B006
    """The findings of one text of the given kinds, by position; rules that none of them needs don't look. Null counts as empty."""
    sight = Sight(raw or "")
    for rule, found in _RULES:
        if not set(found).isdisjoint(kinds):
            rule(sight)
    for wrong in suspects if "suspected_error" in kinds else ():
        for m in re.finditer(re.escape(wrong), sight.text) if wrong else ():
            sight.note("suspected_error", *m.span())
    old = {a for a, b in variants.items() if a and b and a != b}
    new = {b for a, b in variants.items() if a and b and a != b}
    letters = set(sight.text) if old and "variant_mixed" in kinds else set()
    if letters & old and letters & new:
        for i, c in enumerate(sight.text):
            if c in old:
                sight.note("variant_mixed", i, i + 1)
    return sight.findings(kinds)


def patched(raw: str, found: Sequence[Finding]) -> str:
    """The text with its patched findings replaced; what lies under two of them goes once."""
    parts, at = [], 0
    for f in found:
        if f.action == "patched":
            parts += [raw[at : f.raw_start], f.replacement]
            at = max(at, f.raw_end)
    return "".join([*parts, raw[at:]])


_FINDINGS = pa.list_(pa.struct([(n, pa.int32() if n in ("raw_start", "raw_end") else pa.string()) for n in Finding._fields]))


def cleaned(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", variants: Mapping[str, str] | None = None, suspects: Sequence[str] = (), kinds: Sequence[str] = KINDS) -> DataFrame:
    """For each row its id, ``raw_length``, ``findings`` of the given kinds and ``cleaned`` text (with those of them patched that are), in one pass.

    ``variants`` maps older letters to newer ones (a text that has both is mixed), ``suspects`` are likely misreadings. Null texts count as empty; repeated rows stay.
    """
    pairs = dict(variants or {})
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    bound_batches(df.sparkSession)
    schema = f"id {rows.schema['id'].dataType.simpleString()}, raw_length int, findings array<struct<{', '.join(f'{n}:' + ('int' if n in ('raw_start', 'raw_end') else 'string') for n in Finding._fields)}>>, cleaned string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                batch = whole.slice(at, 64)
                texts = batch.column("text").to_pylist()
                found = [examine(t, pairs, suspects, kinds) for t in texts]
                rows_of = [[f._asdict() for f in fs] for fs in found]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(list(map(len, texts)), pa.int32()), pa.array(rows_of, _FINDINGS), pa.array([patched(t, f) for t, f in zip(texts, found, strict=True)], pa.string())],
                    names=["id", "raw_length", "findings", "cleaned"],
                )

    return rows.mapInArrow(tidy(run), schema).withColumnRenamed("id", id_col)


def findings(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", variants: Mapping[str, str] | None = None, suspects: Sequence[str] = (), kinds: Sequence[str] = KINDS) -> DataFrame:
    """One row for each finding of the given kinds with its ``finding_id``. Null and empty texts have none; where every kind has its marks, only texts that have one are read by Python."""
    if MARKED.issuperset(kinds):
        marks = {m for k in kinds for m in MARKS[k]} | ({"---"} if "escape_residue" in kinds else set())
        df = df.where(reduce(Column.__or__, (F.contains(F.col(text_col), F.lit(m)) for m in sorted(marks)), F.lit(False)))
    each = cleaned(df, id_col, text_col, variants, suspects, kinds).select(id_col, F.inline("findings"))
    return each.withColumn("finding_id", F.concat(F.col("kind"), F.lit("@"), F.col("raw_start"), F.lit("-"), F.col("raw_end")))


def clean(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text with its patched findings replaced; only the rules that patch look."""
    return cleaned(df, id_col, text_col, kinds=PATCHED).select(id_col, "cleaned")


def report(found: DataFrame) -> DataFrame:
    """Number of findings by kind in the fixed order, with 0 for kinds without any, and their first five ids by position."""
    spark = found.sparkSession
    kinds = spark.range(1).select(F.posexplode(F.array(*(F.lit(k) for k in KINDS))).alias("place", "kind"))
    first = F.transform(F.slice(F.sort_array(F.collect_list(F.struct("raw_start", "finding_id"))), 1, 5), lambda s: s["finding_id"])
    ranked = found.selectExpr("*", "row_number() OVER (PARTITION BY kind ORDER BY raw_start, raw_end, finding_id) AS r")
    counts = found.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).join(ranked.where("r <= 5").groupBy("kind").agg(first.alias("examples")), "kind")
    return kinds.join(counts, "kind", "left").select("place", "kind", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("examples", F.array().cast("array<string>")).alias("examples"))


def undecided(found: DataFrame, decisions: DataFrame, keys: Sequence[str] = ("finding_id",)) -> DataFrame:
    """Deferred findings without a decision, and decisions about findings that aren't deferred: keys and ``problem``."""
    due, made = found.where("terminal_state = 'deferred'").select(*keys).distinct(), decisions.select(*keys).distinct()
    return due.join(made, list(keys), "left_anti").withColumn("problem", F.lit("no_decision")).unionByName(made.join(due, list(keys), "left_anti").withColumn("problem", F.lit("not_deferred")))


def gate(df: DataFrame, found: DataFrame, clean_texts: DataFrame, decisions: DataFrame, summary: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Five checks that recompute everything: (check, subject, detail) of what fails.

    ``excerpt``: a finding's excerpt is the raw slice; ``closed_sets``: kinds and states are known; ``replay``: patches give the cleaned text;
    ``decisions``: deferred findings are decided; ``counts``: the reported summary (kind, n) is right.
    """
    row = lambda name, subject, detail: [F.lit(name).alias("check"), subject.cast("string").alias("subject"), detail.cast("string").alias("detail")]
    sliced = found.join(df.select(id_col, F.col(text_col).alias("_raw")), id_col, "left").where(~F.coalesce(F.substring("_raw", F.col("raw_start") + 1, F.col("raw_end") - F.col("raw_start")) == F.col("excerpt"), F.lit(False)))
    known = F.col("kind").isin(*KINDS) & F.col("terminal_state").isin("processed", "known_unresolvable", "deferred") & F.col("action").isin("patched", "kept", "flagged")
    replayed = apply_patches(df, patches_from(found.where("action = 'patched'").select(id_col, "raw_start", "raw_end", "replacement"), id_col), id_col, text_col)
    differ = replayed.join(clean_texts.select(id_col, F.col("cleaned").alias("_told")), id_col, "full").where(~F.col("cleaned").eqNullSafe(F.col("_told")))
    counted = found.groupBy("kind").agg(F.count(F.lit(1)).alias("have")).join(summary.select("kind", F.col("n").alias("told")), "kind", "full").where(F.coalesce("have", F.lit(0)) != F.coalesce("told", F.lit(0)))
    return (
        sliced.select(*row("excerpt", F.col("finding_id"), F.col("raw_start")))
        .unionByName(found.where(~F.coalesce(known, F.lit(False))).select(*row("closed_sets", F.col("finding_id"), F.col("kind"))))
        .unionByName(differ.select(*row("replay", F.col(id_col), F.length("cleaned"))))
        .unionByName(undecided(found, decisions).select(*row("decisions", F.col("finding_id"), F.col("problem"))))
        .unionByName(counted.select(*row("counts", F.col("kind"), F.col("have"))))
    )


def replay_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per text: findings, patches, raw and cleaned length, and whether the lengths agree with the patches."""
    spent = lambda p: F.length(p["replacement"]) - (p["raw_end"] - p["raw_start"])
    patches = F.filter("findings", lambda f: f["action"] == "patched")
    shift = F.aggregate(patches, F.lit(0), lambda total, p: total + spent(p))
    # Raw positions are sorted, so a patch overlaps if it starts before the furthest end so far.
    overlaps = F.aggregate(patches, F.struct(F.lit(0).alias("end"), F.lit(False).alias("hit")), lambda acc, p: F.struct(F.greatest(acc["end"], p["raw_end"]).alias("end"), (acc["hit"] | (p["raw_start"] < acc["end"])).alias("hit")))["hit"]
    seen = cleaned(df, id_col, text_col)
    return seen.select(id_col, F.size("findings").cast("long").alias("n_findings"), F.size(patches).cast("long").alias("n_patches"), "raw_length", F.length("cleaned").alias("cleaned_length"), overlaps.alias("overlaps"), ((F.length("cleaned") == F.col("raw_length") + shift) | overlaps).alias("replayed"))
