"""Template residue: unfilled placeholders, filler, error pages and script notices.

Texts are cut into segments, and segments with something that residue may have are
aligned over all texts. What looks like a template's variable is a slot candidate; the
words on either side are its frames. A frame that different candidates fill in several
texts is a template's slot, and candidates in one, or with names made of parts that
several texts' delimited variables have, are placeholders left as they were, be they
names, defaults or blanks. Segments with a word of pages that went wrong or of filler
only seed: their runs of words, numbers and names as slots, are aligned, and a run that
whole pages of nothing else repeat is a template of such pages, wherever it stands.
"""

from __future__ import annotations

import html
import re

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settle, table

# A variable's name, and delimiters that hold one; those no prose uses, and those it may use.
_NAME = r"#?[A-Za-z][A-Za-z0-9_.-]*(?: [A-Z][A-Z0-9_.]+)?"
_FLAGS = r"(?:\s*\|\s*[a-z]+)?"
STRONG = "|".join([
    r"\{\{\s*(?:NAME|[0-9]+)FLAGS\s*\}\}", r"\$\{\s*(?:NAME)\s*\}", r"\$\((?:NAME)\)", r"#\{(?:NAME)\}", r"<%=?\s*(?:NAME)\s*%>", r"\{%\s*(?:NAME)\s*%\}",
    r"%%(?:NAME)%%", r"%\((?:NAME)\)[sd]", r"\[\[(?:NAME)FLAGS\]\]", r"@@(?:NAME)@@", r"\*\|(?:NAME)\|\*", r"\?\?(?:NAME)\?\?",
    r"\b__[A-Z][A-Za-z_.]*[A-Za-z]__", r"\b[A-Z][A-Z_.]*_PLACEHOLDER\b", r"\[YOUR (?:NAME)\]", r"[\[<(](?:insert|add) (?:NAME)(?: here)?[\])>]",
    r"&lt;(?:insert )?(?:NAME)(?: here)?&gt;",
]).replace("NAME", _NAME).replace("FLAGS", _FLAGS)
WEAK = "|".join([
    r"\{(?:NAME|[0-9]+)?\}", r"<(?:NAME)>", r"\[(?:NAME)?\]", r"(?<![\w:]):(?:NAME):(?![\w:])", r"%(?:NAME)%", r"\[(?:NAME) TBD\]",
    r"\b[a-z]+(?:[A-Z][a-z]+)+\b", r"\b[A-Za-z]+(?:_[A-Za-z]+)+\b", r"\b[A-Z]{6,}\b", r"\(\)", r"_{3,}",
]).replace("NAME", _NAME)
#: Words of a delimited slot that aren't part of a variable's name.
_NOISE = {"your", "insert", "add", "here", "placeholder", "upper", "lower", "default", "title", "tbd", "lt", "gt", "s", "d"}
_SLOT_SIGNS = re.compile(r"[{\[<]|\$\(|%%|%[A-Za-z(]|\?\?|\*\||@@|&lt;|_|PLACEHOLDER|:[A-Za-z_.]+:|\((?:add|insert) |\(\)|[a-z][A-Z]|[A-Z]{6}")

# Pieces of words by which pages that went wrong, script notices and filler are looked for, in lower case without accents.
SEEDS = """
script|js|スクリプト|скрипт|skript|browser|navegador|navigateur|cookie|error|erreur|fehler|erro |erro:|ошибк|エラー|http|status|exception|traceback|uncaught|
not found|introuvable|encontrad|gefunden|найден|ページ|страниц|unavailable|forbidden|denied|acceso|acces refuse|zugriff|permission|blocked|suspended|expired|
gateway|upstream|server|connection|conexao|conexion|connexion|verbindung|database|datenbank|maintenance|offline|timed out|reset|refused|too many|gone|request|
retry|reload|refresh|try again|try later|slow down|tente nov|intentelo|spater|reessayez|попробуйте|oops|sorry|hmm|unexpected|something |could not|did not answer|
no such|no longer|not available|does not exist|you asked|removed or|enlace|start page|log in|sign in|
placeholder|dummy|lorem|ipsum|dolor|amet|consec| sit |filler|blindtext|sample |mock |demo text|demo copy|demo content|demo paragraph|demo biography|example|ejemplo|exemplo|beispiel|provis|remplacer|ersetzen|hier steht|
текст|テキスト|文章|goes here| here|in this box|in this field|before publishing|click to|add your|paste |replace |write two|words)|(max|(ignore|
your name|your text|your bio|biography|todo|coming soon|asdf|foo bar|undefined|null|[object|nan|xxx|blah|bla...
""".replace("\n", "").split("|")
#: Verbs that an instruction to the writer begins with.
_VERBS = re.compile(r"(?:^|[.!?;。]\s+|\n)[ \-•*]*(?:type|insert|enter|put|paste|write|add|replace) ")
_ACCENTS = str.maketrans("áàâãäåéèêëíìîïóòôõöúùûüçñ", "aaaaaaeeeeiiiiooooouuuucn")
_QUOTED = re.compile(r"\"[^\"\n]*\"|“[^”\n]*”|„[^“”\n]*[“”]|«[^»\n]*»|「[^」\n]*」")
_CUT = re.compile(r"(?<=[.!?;。])\s+|\n+")
_AGAIN = re.compile(r"\b([^\W\d_]{2,12})\b(?:[^\w\n]{1,5}\1\b){3}")
_MASH = re.compile(r"\b[b-df-hj-np-tv-xz]{3,}\b|[b-df-hj-np-tv-xz]{5}|q[a-tv-z]|[a-z];[a-z]")
_WORDS = re.compile(r"[^\W_]+")
_NUMBERS = re.compile(r"\b(?=[0-9A-Fa-f]*\d)[0-9A-Fa-f]{6,}\b|\d+")
_NAMES = regex.compile(r"(?<=[\p{Ll},] )\p{Lu}[\p{L}'’-]+(?: (?:& )?\p{Lu}[\p{L}'’-]+)*")
_SLOT_WORDS, _DELIMITED = {"n", "0"}, re.compile(r"[^A-Za-z_(]")
_GAPS = regex.compile(r"[^\p{L}0]+")

#: Words of a run.
RUN = 3
#: Whole pages that must have a run, and their share of the texts with it, for it to be a template of such pages.
PAGES, PAGE_SHARE = 2, 0.3
#: Words besides the seeded segments that a whole page may have (a menu, a name), and how many for each seeded word.
OTHER_WORDS, OTHER_RATE = 12, 3.0
#: Words for each seed that a whole page may have at most, and letters from which a word without blanks counts as two.
SEED_RATE, LONG_WORD = 16, 12
#: Texts and different fillers that make a frame a slot, and texts that make a part of a name a variable's.
FRAME_TEXTS, NAME_TEXTS = 2, 2


def plain_of(text: str) -> str:
    """Lower case, entities resolved, accents of Latin letters off."""
    if "&" in text:
        text = html.unescape(text)
    text = text.lower()
    return text if text.isascii() else text.translate(_ACCENTS)


def template_words(segment: str) -> list[list[str]]:
    """The words of a segment with its numbers as slots, and, if it has any, with its names too; quotes left out."""
    numbered = _NUMBERS.sub("0", _QUOTED.sub(" ", segment))
    unnamed = _NAMES.sub("N", numbered)
    return [_GAPS.sub(" ", out.lower()).split() for out in ([numbered] if unnamed == numbered else [numbered, unnamed])]


def name_parts(named: str) -> list[str]:
    """The parts of a slot's name in order: camel case, points, hyphens and underscores part them."""
    parts = re.sub(r"[^a-z]+", " ", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", named).lower()).split()
    return [x for x in parts if x not in _NOISE]


def _looks_mashed(plain: str) -> bool:
    """Whether some words in a row look like keys struck at random."""
    hits = [m.start() for m in _MASH.finditer(plain)]
    return any(b - a < 40 and " " in plain[a:b] for a, b in zip(hits, hits[1:]))


class _Reader:
    """Finds what concerns us in one text."""

    def __init__(self):
        self.seeds = ahocorasick.Automaton()
        for word in SEEDS:
            self.seeds.add_word(word, word)
        self.seeds.make_automaton()
        self.strong, self.slots = regex.compile(STRONG), regex.compile(f"(?P<s>{STRONG})|(?:{WEAK})")

    def read(self, text: str) -> tuple[list[tuple], list[str], bool, bool]:
        """(slots, runs, whole, filler): slot candidates (strong, parts, filler, frames), runs of seeded segments, whether
        there is nothing else, and whether words are repeated or keys mashed."""
        all_plain = plain_of(text)
        mashed = _looks_mashed(all_plain)
        again = _AGAIN.search(all_plain) is not None
        signs = _SLOT_SIGNS.search(text) is not None
        if not (mashed or again or signs or _VERBS.search(all_plain) or next(self.seeds.iter(all_plain), None)):
            return [], [], False, False
        slots: list[tuple] = []
        runs: set[str] = set()
        filler = again and _AGAIN.search(_QUOTED.sub(" ", all_plain)) is not None
        seeded = other = found = 0
        for segment in _CUT.split(text):
            n = sum(1 + len(w) // LONG_WORD for w in _WORDS.findall(segment))
            if not n and not segment.strip():
                continue
            here = self._slots(segment) if signs and _SLOT_SIGNS.search(segment) else []
            slots += here
            if any(strong for strong, *_ in here):
                seeded += n
                continue
            bare = _QUOTED.sub(" ", plain_of(segment))
            if mashed and _looks_mashed(bare):
                filler = True
                seeded += n
                continue
            hits = [w for _, w in self.seeds.iter(bare)]
            if not hits and not _VERBS.match(bare.lstrip()):
                other += 0 if any(_DELIMITED.match(s[2]) for s in here) else n
                continue
            seeded += n
            found += max(1, len(hits)) * SEED_RATE - n
            for words in template_words(segment):
                runs.update(" ".join(words[i : i + RUN]) for i in range(max(1, len(words) - RUN + 1)) if sum(w not in _SLOT_WORDS for w in words[i : i + RUN]) > (len(words) > 1))
            runs.update("~".join(hits[i : i + RUN]) for i in range(len(hits) - RUN + 1))
        whole = found >= 0 and other <= OTHER_WORDS and other <= OTHER_RATE * seeded
        if whole and runs:
            runs.add(" ".join(w for segment in _CUT.split(text) for w in template_words(segment)[0]))  # the page itself
        return slots, sorted(runs), whole, filler

    def _slots(self, segment: str) -> list[tuple]:
        out = []
        for m in self.slots.finditer(segment):
            parts = name_parts(m.group())
            strong = m.group("s") is not None
            if strong and not parts and not any(c.isdigit() for c in m.group()):
                continue
            left, right = _WORDS.findall(segment[: m.start()].lower())[-2:], _WORDS.findall(segment[m.end() :].lower())[:2]
            frames = [f"{' '.join(left)} <>"] if len(left) == 2 else []
            frames += [f"<> {' '.join(right)}"] if len(right) == 2 else []
            out.append((strong, parts, m.group(), frames))
        return out


_SLOT = pa.struct([("strong", pa.bool_()), ("parts", pa.list_(pa.string())), ("filler", pa.string()), ("frames", pa.list_(pa.string()))])
_MARKS = "doc_id bigint, slots array<struct<strong:boolean,parts:array<string>,filler:string,frames:array<string>>>, runs array<string>, whole boolean, filler boolean"


def _marks(batches):
    reader = _Reader()
    for batch in batches:
        out = []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            slots, runs, whole, filler = reader.read(text)
            if slots or runs or filler:
                named = [dict(zip(("strong", "parts", "filler", "frames"), s)) for s in slots]
                out.append((doc, named, runs, whole, filler))
        cols = list(zip(*out)) or [()] * 5
        types = (pa.int64(), pa.list_(_SLOT), pa.list_(pa.string()), pa.bool_(), pa.bool_())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["doc_id", "slots", "runs", "whole", "filler"])


def placeholders(marks: DataFrame) -> DataFrame:
    """(doc_id, template) of texts with a variable left in: template is a frame that others fill too; null where the name
    or the delimiters alone tell it."""
    slots = marks.select("doc_id", F.monotonically_increasing_id().alias("row"), F.posexplode("slots").alias("place", "s")).select("doc_id", "row", "place", "s.*")
    slots = settle(slots)
    # parts of names, and parts in a row written as one, that variables in delimiters have in several texts
    n = F.size("parts")
    spans = F.flatten(F.transform(F.sequence(F.lit(1), n), lambda i: F.transform(F.sequence(i, n), lambda j: F.array_join(F.slice("parts", i, j - i + 1), ""))))
    named = slots.where("strong and size(parts) > 0").select("doc_id", F.explode(F.array_distinct(spans)).alias("part"))
    variables = named.groupBy("part").agg(F.count_distinct("doc_id").alias("texts")).where(F.col("texts") >= NAME_TEXTS).select("part")
    parts = slots.select("row", "place", F.size("parts").alias("size"), F.explode("parts").alias("part")).join(variables.withColumn("known", F.lit(1)), "part", "left")
    known = parts.groupBy("row", "place").agg((F.sum(F.coalesce("known", F.lit(0))) == F.max("size")).alias("known"))
    slots = settle(slots.join(known, ["row", "place"], "left").withColumn("known", F.coalesce("known", F.lit(False))))

    framed = slots.select("doc_id", "row", "place", "strong", "known", "filler", F.explode("frames").alias("frame"))
    sure = F.col("strong") | F.col("known")
    frames = framed.groupBy("frame").agg(
        F.count_distinct("doc_id").alias("texts"), F.count_distinct("filler").alias("fillers"), F.count_if(sure).alias("sure"), F.count("*").alias("n")
    ).where((F.col("texts") >= FRAME_TEXTS) & (F.col("fillers") >= 2) & (F.col("sure") * 2 >= F.col("n"))).select("frame")
    aligned = framed.join(frames, "frame").groupBy("row", "place").agg(F.min("frame").alias("template"))
    told = slots.join(aligned, ["row", "place"], "left")
    bare = ~F.col("filler").rlike(r"[^A-Za-z_]")  # an identifier without delimiters needs both its name and its place
    left_in = F.col("strong") | F.when(bare, F.col("known") & F.col("template").isNotNull()).otherwise(F.col("known") | (F.col("template").isNotNull() & ((F.size("parts") == 0))))
    return told.where(left_in).groupBy("doc_id").agg(F.min("template").alias("template"))


def page_templates(marks: DataFrame) -> DataFrame:
    """(doc_id, template) of texts with a run of words that whole pages of nothing else repeat."""
    runs = marks.select("doc_id", "whole", F.explode("runs").alias("run"))
    counts = runs.groupBy("run").agg(F.count("*").alias("texts"), F.count_if("whole").alias("pages"))
    repeated = counts.where((F.col("pages") >= PAGES) & (F.col("pages") >= PAGE_SHARE * F.col("texts"))).select("run")
    return runs.join(repeated, "run").groupBy("doc_id").agg(F.min("run").alias("template"))


def residue(documents: DataFrame) -> DataFrame:
    """(doc_id, why, template) of each text that is residue or has some: placeholder, page or filler.

    ``documents`` has doc_id and text; other columns are ignored. Null, empty and blank
    texts have none. Repeated rows count once; texts of any length are read whole.
    ``template`` is a frame or a run of words that the text has in common with others.
    """
    rows = documents.where("doc_id is not null and trim(text) <> ''").select("doc_id", "text")
    marks = settle(rows.mapInArrow(_marks, _MARKS).distinct())
    filler = marks.where("filler").select("doc_id", F.lit("filler").alias("why"), F.lit(None).cast("string").alias("template"))
    of = lambda df, why: df.select("doc_id", F.lit(why).alias("why"), "template")
    return of(placeholders(marks), "placeholder").unionByName(of(page_templates(marks), "page")).unionByName(filler)


def p9_found(spark, sf_dir: str) -> DataFrame:
    return residue(table(spark, sf_dir, "documents")).select("doc_id").distinct()


QUERIES = {"p9_found": p9_found}
SQL: dict[str, str] = {}
