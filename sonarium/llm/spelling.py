"""Names as people type them, in a plain form: letters, word by word, without dress.

The plain form undoes what typing and copying do to a name without a slip of the
finger: case, accents, look-alike digits, Cyrillic letters, decorations, short forms
of common words, nicknames and letters that sound alike.
"""

from __future__ import annotations

import re
import unicodedata

# Cyrillic letters as Latin ones.
CYRILLIC = dict(
    zip(
        "абвгдеёжзийклмнопрстуфхцчшщъыьэюя",
        "a b v g d e e zh z i i k l m n o p r s t u f h ts ch sh sch  y  e yu ya".split(" "),
    )
)
# Digits and signs that stand for letters inside a word.
LOOKALIKE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "$": "s", "@": "a"})
# Short or foreign forms of words that names of acts are made of.
WORD_FORMS = {
    "bros": "brothers", "sis": "sisters", "sistas": "sisters", "exp": "experience", "xperience": "experience",
    "bigband": "big band", "kollektiv": "collective", "coll": "collective", "proj": "project", "projekt": "project",
    "phil": "philharmonic", "philharmonie": "philharmonic", "koor": "choir", "chor": "choir",
    "4tet": "quartet", "quartett": "quartet", "ensamble": "ensemble", "ens": "ensemble", "orch": "orchestra",
    "orchester": "orchestra", "orkestra": "orchestra", "soundsystem": "sound system", "soundsys": "sound system",
    "3o": "trio", "s/s": "sound system", "mk": "mc", "di": "dj", "musik": "music",
}
#: Words of one part that short forms stand for.
_WHOLE = sorted({w for w in WORD_FORMS.values() if w.isalpha() and len(w) > 3})
# Nicknames of given names.
NICKNAMES = {
    "abigail": "abby gail abbie", "alexander": "alex xander sasha al sandy lex", "anthony": "tony ant", "benjamin": "ben benji benny",
    "charles": "charlie chuck chas", "christopher": "chris kit topher kris", "dorothea": "dora thea dot dolly", "eduardo": "edu lalo eddie",
    "elizabeth": "liz beth eliza betty lizzie", "emmanuel": "manu manny", "francisca": "fran paquita paca francis", "frederick": "fred freddy freddie",
    "gabriela": "gabi gaby ela", "giuseppe": "beppe pino peppe", "henrietta": "hettie etta hetty", "isabella": "bella izzy isa",
    "johanna": "jo hanne hanna", "jonathan": "jon jonny johnny", "josephine": "josie jo fina", "katherine": "kat kate kathy katie",
    "leonardo": "leo nardo", "margaret": "maggie meg peggy greta", "maximilian": "max maxi", "mikhail": "misha mika",
    "nathaniel": "nate nat", "philippa": "pippa pip", "rebecca": "becky bex becca", "richard": "dick rick richie rich",
    "robert": "bob bobby rob robbie", "rosalind": "roz rosa ros", "samantha": "sam sammie sammy", "sebastian": "seb bastian bas",
    "theodore": "ted teddy theo", "ursula": "uschi ursi", "valentina": "val tina", "vladimir": "vova vlad volodya",
    "wilhelmina": "willa mina minna billie", "william": "bill billy will willy liam",
}
_GIVEN: dict[str, list[str]] = {}
for _full, _short in NICKNAMES.items():
    for _s in _short.split():
        _GIVEN.setdefault(_s, []).append(_full)
# Words that come and go with a name.
LOOSE = {"the", "and", "und", "official", "topic", "live", "music", "hq", "of"}
JOINERS = {"y", "n", "e", "et"}
TITLES = {"dj", "mc", "the"}

_BRACKETS = re.compile(r"[(\[]([^)\]]*)[)\]]")
_CAMEL = re.compile(r"(?<=[a-zß-ÿ])(?=[A-ZÀ-Þ])")
_SPLIT = re.compile(r"[\s_.,&+|–—-]+|(?<!s)/|/(?!s)")
_KEEP = re.compile(r"[^a-z0-9/]+")
#: Letters that sound or look alike, as one; order matters.
_SOUNDS = [("ays", "eis"), ("ay", "ei"), ("ai", "ei"), ("ey", "ei"), ("ph", "f"), ("ck", "k"), ("x", "ks"), ("c", "k"), ("q", "k"), ("w", "v"), ("j", "i"), ("y", "i"), ("z", "s"), ("th", "t"), ("h", "")]


def fold(text: str) -> str:
    """Lower case, without accents, in Latin letters."""
    text = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).casefold()
    if not text.isascii():
        text = "".join(CYRILLIC.get(c, c) for c in text)
        text = text.replace("ø", "o").replace("æ", "ae").replace("œ", "oe").replace("đ", "d").replace("ł", "l").replace("ı", "i")
    return text


def tokens(name: str | None) -> list[str]:
    """The words of a name in plain form, as typed in order; none for a null or blank name."""
    if not name:
        return []
    extra = []

    def bracket(m: re.Match) -> str:
        inner = fold(m.group(1)).strip()
        if inner in TITLES:
            extra.append(inner)
        return " "

    bare = _BRACKETS.sub(bracket, name)
    if not bare.strip():
        bare, extra = name, []
    if not re.search(r"\s", bare.strip()):
        bare = _CAMEL.sub(" ", bare)
    out = list(extra)
    hyphened = " " in bare.strip()
    for piece in re.split(r"\s+", fold(bare)):
        parts = [piece.replace("-", "")] if hyphened and piece.count("-") == 1 and not piece.startswith("-") else [piece]
        for part in parts:
            for w in _SPLIT.split(part):
                w = w.replace("'", "").replace("’", "").strip("!®?*\"“”«»")
                if re.search("[a-z$]", w) and w not in WORD_FORMS:
                    w = w.translate(LOOKALIKE)
                w = _KEEP.sub("", w)
                w = WORD_FORMS.get(w) or contracted(w)
                out += [x for x in w.split(" ") if x]
    last = len(out) - 1
    kept = [
        w for i, w in enumerate(out)
        if not (w.replace("kh", "h") in LOOSE or (0 < i < last and w in JOINERS) or (i == last > 0 and w.isdigit()) or (w == "band" and i > 1 and out[i - 1] != "big"))
    ]
    return kept or out


def contracted(word: str) -> str:
    """A word of three or more consonants as the one word of a kind of act that begins like it and has them in this order;
    the word itself if there is no such word or several."""
    if len(word) < 3 or not word.isalpha() or set(word) & set("aeiouy"):
        return word
    fit = [w for w in _WHOLE if w[0] == word[0] and re.search(".*".join(word), w)]
    return fit[0] if len(fit) == 1 else word


def sound(word: str) -> str:
    """A word by its sound: letters that are taken for one another are one, doubled ones single."""
    for a, b in _SOUNDS:
        word = word.replace(a, b)
    return re.sub(r"(.)\1+", r"\1", word)


def given_names(word: str) -> list[str]:
    """The given names that a nickname may stand for."""
    return _GIVEN.get(word, [])


def distance(a: str, b: str, most: int) -> int:
    """Edits with neighbouring letters swapped as one, up to ``most``; ``most + 1`` if there are more."""
    if a == b:
        return 0
    n, m = len(a), len(b)
    if abs(n - m) > most:
        return most + 1
    before, last = [], list(range(m + 1))
    for i in range(1, n + 1):
        row = [i] + [0] * m
        for j in range(1, m + 1):
            d = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d = min(d, before[j - 2] + 1)
            row[j] = d
        if min(row) > most:
            return most + 1
        before, last = last, row
    return min(last[m], most + 1)
