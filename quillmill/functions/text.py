"""Text columns: line format, transliteration, ids, counts and lists."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F, types as T

PARAGRAPH_SEPARATOR = "<p>"

# What str.split() and str.strip() take as blank: Unicode white space and U+001C-U+001F.
BLANK = r"\s\x1c-\x1f"
TOKEN = f"(?U)[^{BLANK}]+"
STRIP = rf"(?U)\A[{BLANK}]+|[{BLANK}]+\z"

ASCII_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def let(c: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often it is used.

    Nesting plain expressions copies their inputs; chains of such copies grow fast.
    """
    return F.element_at(F.transform(F.array(c), body), 1)


def replace_linebreaks(c: Column) -> Column:
    """One-line form of a text: line breaks become ``<p>``, each rule applied once.

    The four literal replacements are deliberately single-pass: a run of four blanks
    becomes two, not one.
    """
    sep = PARAGRAPH_SEPARATOR
    for old, new in (("\r", ""), ("\n", f" {sep} "), (f"{sep}  {sep}", sep), ("  ", " ")):
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


# --- transliteration -----------------------------------------------------------------
# ASCII spellings of characters without a Unicode decomposition to ASCII.
LATIN_AND_SYMBOLS = {
    "\u00a0": " ", "¡": "!", "¢": "C/", "£": "PS", "¤": "$?", "¥": "Y=", "¦": "|", "§": "SS",
    "¨": '"', "©": "(c)", "ª": "a", "«": "<<", "¬": "!", "\u00ad": "", "®": "(r)", "¯": "-",
    "°": "deg", "±": "+-", "²": "2", "³": "3", "´": "'", "µ": "u", "¶": "P", "·": "*",
    "¸": ",", "¹": "1", "º": "o", "»": ">>", "¼": "1/4", "½": "1/2", "¾": "3/4", "¿": "?",
    "Æ": "AE", "Ð": "D", "×": "x", "Ø": "O", "Þ": "Th", "ß": "ss", "æ": "ae", "ð": "d",
    "÷": "/", "ø": "o", "þ": "th", "Đ": "D", "đ": "d", "Ħ": "H", "ħ": "h", "ı": "i",
    "Ĳ": "IJ", "ĳ": "ij", "ĸ": "k", "Ŀ": "L", "ŀ": "l", "Ł": "L", "ł": "l", "ŉ": "'n",
    "Ŋ": "NG", "ŋ": "ng", "Œ": "OE", "œ": "oe", "Ŧ": "T", "ŧ": "t", "ſ": "s", "ƒ": "f",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "--", "―": "--", "‘": "'", "’": "'",
    "‚": ",", "‛": "'", "“": '"', "”": '"', "„": ",,", "†": "+", "‡": "++", "•": "*",
    "…": "...", "‰": "%0", "′": "'", "″": '"', "‹": "<", "›": ">", "€": "EUR", "№": "No",
    "™": "tm", "−": "-", "₤": "L", "₦": "N", "₨": "Rs", "₩": "W", "₪": "NS", "₫": "D", "₮": "T", "₹": "Rs", "₽": "R", "\u2009": " ", "\u200a": " ", "\u202f": " ", "\u2028": "\n", "\u2029": "\n\n",
}
GREEK = {
    "α": "a", "β": "b", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "e", "θ": "th", "ι": "i",
    "κ": "k", "λ": "l", "μ": "m", "ν": "n", "ξ": "x", "ο": "o", "π": "p", "ρ": "r", "ς": "s",
    "σ": "s", "τ": "t", "υ": "u", "φ": "ph", "χ": "kh", "ψ": "ps", "ω": "o",
}
CYRILLIC = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ж": "zh", "з": "z", "и": "i",
    "й": "i", "к": "k", "л": "l", "м": "m", "н": "n", "о": "o", "п": "p", "р": "r", "с": "s",
    "т": "t", "у": "u", "ф": "f", "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch",
    "ъ": '"', "ы": "y", "ь": "'", "э": "e", "ю": "iu", "я": "ia", "ё": "io", "є": "ie",
    "і": "i", "ї": "yi",
}

HEBREW = dict(zip("אבגדהוזחטיךכלםמןנסעףפץצקרשת", "A b g d h v z KH t y k k l m m n n s ` p p TS TS q r SH t".split()))
ARABIC = dict(zip("بتثجحخدذرزسشصضطظعغفقكلمنهوىيپچژکگی", "b t th j H kh d dh r z s sh S D T Z ` G f q k l m n h w ~ y p ch zh k g y".split())) | {
    "ء": "", "آ": "a", "أ": "'", "ؤ": "w'", "إ": "", "ئ": "y'", "ا": "", "ة": "@", "ـ": "", "،": ",", "؛": ";", "؟": "?",
}
GEORGIAN = dict(zip("აბგდევზთიკლმნოპჟრსტუფქღყშჩცძწჭხჯჰ", "a b g d e v z t` i k l m n o p zh r s t u p` k` g' q sh ch` ts dz ts' ch' kh j h".split()))
ARMENIAN = dict(zip("աբգդեզէըթժիլխծկհձղճմյնշոչպջռսվտրցւփքօֆ", "a b g d e z e e t` zh i l kh ts k h dz gh ch m y n sh o ch` p j rh s v t r ts` w p` k` o f".split())) | {"և": "ew", "։": ":"}
THAI = dict(
    zip("กขฃคฅฆงจฉชซฌญฎฏฐฑฒณดตถทธนบปผฝพฟภมยรฤลฦวศษสหฬอฮ", "k kh kh kh kh kh ng cch ch ch ch ch y d t th th th n d t th th th n b p ph f ph f ph m y r R l L w s s s h l ` h".split())
) | {"ฯ": "~", "ะ": "a", "ั": "a", "า": "aa", "ำ": "am", "ิ": "i", "ี": "ii", "ึ": "ue", "ื": "uue", "ุ": "u", "ู": "uu", "เ": "e", "แ": "ae", "โ": "o", "ใ": "ai", "ไ": "ai", "ๆ": "+"}
# Scripts of India whose Unicode names are the sounds: blocks of 128 code points.
INDIC = ("DEVANAGARI", "BENGALI", "GURMUKHI", "GUJARATI", "ORIYA", "TAMIL", "TELUGU", "KANNADA", "MALAYALAM")


def _indic() -> dict[str, str]:
    """Letters of INDIC by name: a consonant without its vowel, a vowel or its sign as it sounds."""
    known = {"।": ".", "॥": ".."}
    for letter in map(chr, range(0x0900, 0x0D80)):
        name = unicodedata.name(letter, "").split()
        if name[:1] and name[0] in INDIC and len(name) > 2:
            kind, sound = " ".join(name[1:-1]), name[-1].lower()
            if name[-2] == "VOCALIC":
                known[letter] = sound.upper()
            elif kind.startswith("LETTER"):
                known[letter] = sound[:-1] if len(sound) > 1 and sound.endswith("a") and sound.strip("aeiou") else sound
            elif kind.startswith("VOWEL SIGN"):
                known[letter] = sound
            elif name[1] == "SIGN":
                known[letter] = {"candrabindu": "N", "anusvara": "N", "visarga": "H"}.get(sound, "")
    return known


def _digits() -> dict[str, str]:
    """Decimal digits of all scripts."""
    return {c: str(unicodedata.decimal(c)) for c in map(chr, range(0x80, 0x1E000)) if unicodedata.category(c) == "Nd"}


# Parts of a Korean syllable: 19 beginnings, 21 vowels, 28 endings.
HANGUL = (
    "g gg n d dd r m b bb s ss - j jj c k t p h".split(),
    "a ae ya yae eo e yeo ye o wa wae oe yo u weo we wi yu eu yi i".split(),
    "- g gg gs n nj nh d l lg lm lb ls lt lp lh m b bs s ss ng j c k t p h".split(),
)


def _kana() -> dict[str, str]:
    """Japanese syllables by their Unicode names, and the marks between them."""
    known = {"ー": "-", "・": ".", "、": ", ", "。": ". ", "「": "[", "」": "]"}
    for letter in map(chr, range(0x3041, 0x30FB)):
        name = unicodedata.name(letter, "").split()
        if len(name) >= 3 and name[1] == "LETTER":
            known[letter] = "n" if name[-1] == "N" else {"SI": "shi", "TI": "chi", "TU": "tsu", "HU": "fu", "ZI": "ji", "DI": "ji", "DU": "zu"}.get(name[-1], name[-1].lower())
    return known


def _hangul(letter: Column) -> Column:
    """Spelling of a Korean syllable, from the arithmetic of its code point; else null."""
    place = F.ascii(letter) - 0xAC00
    begin, vowel, end = (F.array(*[F.lit("" if x == "-" else x) for x in part]) for part in HANGUL)
    parts = ((begin, F.floor(place / 588)), (vowel, F.floor(F.pmod(place, F.lit(588)) / 28)), (end, F.pmod(place, F.lit(28))))
    return F.when(letter.between("가", "힣"), F.concat(*[F.element_at(table, (i + 1).cast("int")) for table, i in parts]))


def _with_capitals(table: dict[str, str]) -> dict[str, str]:
    """Add capital letters: the spelling's first letter is capital, too."""
    return table | {k.upper(): v[:1].upper() + v[1:] for k, v in table.items() if len(k.upper()) == 1 and k.upper() != k}


def _ascii_spellings() -> dict[str, str]:
    """All known spellings: the fixed values, and what Unicode decomposition gives.

    Accented letters take their base letter's spelling; ligatures, full-width forms,
    raised, circled and Roman numbers take their compatibility form when that is ASCII.
    """
    known = LATIN_AND_SYMBOLS | _with_capitals(GREEK) | _with_capitals(CYRILLIC) | _with_capitals(ARMENIAN)
    known |= HEBREW | ARABIC | GEORGIAN | THAI | _indic() | _kana() | _digits()
    for start, end in ((0x00C0, 0x0250), (0x0370, 0x0530), (0x1E00, 0x2000)):
        for letter in map(chr, range(start, end)):
            base = unicodedata.normalize("NFD", letter)[0]
            spelling = base if base.isascii() else known.get(base)
            if base != letter and spelling is not None:
                known.setdefault(letter, spelling)
    for start, end in ((0x2070, 0x2190), (0x2460, 0x2500), (0xFB00, 0xFB07), (0xFF01, 0xFF5F)):
        for letter in map(chr, range(start, end)):
            spelling = unicodedata.normalize("NFKD", letter).replace("⁄", "/")
            if spelling.isascii():
                known.setdefault(letter, spelling)
    return known


_SPELLINGS = _ascii_spellings()
NON_ASCII = r"[^\x00-\x7F]"
#: Letters are looked up by place: each stands for a code point of the private plane 15.
CODES, CODES_END = 0xF0000, 0xFFFFE
MOST_SPELLINGS = 60_000
#: Distinct letters of a text up to which each is replaced in the whole text.
FEW_LETTERS = 48
#: Characters that no table has to spell: combining marks are dropped, Korean syllables computed.
MARK_OR_HANGUL = r"[\p{Mn}가-힣]"


def _spelling(letter: Column, spellings: dict[str, str]) -> Column:
    """ASCII of one letter, null where none is known; one look-up however large the table is."""
    codes = "".join(map(chr, range(CODES, CODES + len(spellings))))
    values = F.split(F.lit("\x00".join(spellings.values())), "\x00")
    place = F.ascii(F.translate(letter, "".join(spellings), codes)) - CODES
    own = letter.between(chr(CODES), chr(CODES_END))  # a code that stands in the text itself
    return F.coalesce(_hangul(letter), F.when((place >= 0) & (place < len(spellings)) & ~own, F.get(values, place)))


def _known(spellings: dict[str, str] | None) -> dict[str, str]:
    known = _SPELLINGS | {k: v for k, v in (spellings or {}).items() if len(k) == 1 and not k.isascii()}
    if len(known) > CODES_END - CODES:
        raise ValueError("more spellings than codes")
    return known


def decode_unicode(c: Column, spellings: dict[str, str] | None = None) -> Column:
    """ASCII transliteration; characters without a known spelling are removed.

    ``spellings`` adds letters to the known ones, or changes theirs; ``lost_characters``
    counts what is removed. Pure ASCII texts skip all work. In texts with few distinct
    letters each is replaced once, in others every character is spelt in one pass.
    """
    table = _known(spellings)
    letters = F.array_distinct(F.regexp_extract_all(c, F.lit(NON_ASCII), 0))

    def spelled(found: Column) -> Column:
        pairs = F.transform(found, lambda a: F.struct(a.alias("letter"), F.coalesce(_spelling(a, table), F.lit("")).alias("ascii")))
        few = F.aggregate(pairs, c, lambda text, s: F.replace(text, s["letter"], s["ascii"]))
        each = F.transform(F.split(c, ""), lambda a: F.when(a.rlike(NON_ASCII), F.coalesce(_spelling(a, table), F.lit(""))).otherwise(a))
        return F.when(F.size(found) <= FEW_LETTERS, few).otherwise(F.array_join(each, ""))

    return F.when(c.rlike(NON_ASCII), let(letters, spelled)).otherwise(c)


def lost_characters(c: Column, spellings: dict[str, str] | None = None) -> Column:
    """How many characters ``decode_unicode`` removes because it knows no spelling.

    Combining marks and characters whose spelling is empty are not losses.
    """
    table = _known(spellings)
    rest = F.regexp_replace(F.translate(c, "".join(table), ""), MARK_OR_HANGUL, "")
    return F.when(c.rlike(NON_ASCII), F.regexp_count(rest, F.lit(NON_ASCII))).when(c.isNotNull(), F.lit(0))


def decode_unicode_record(df: DataFrame) -> DataFrame:
    """``decode_unicode`` on every string column."""
    strings = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.select(
        *[decode_unicode(df[f"`{n}`"]).alias(n) if n in strings else df[f"`{n}`"] for n in df.columns]
    )


# --- tokens, lines, lists ------------------------------------------------------------


def tokens(c: Column) -> Column:
    """Blank-separated words, as ``str.split()`` gives them."""
    return F.regexp_extract_all(c, F.lit(TOKEN), 0)


def token_count(c: Column) -> Column:
    """Number of blank-separated words of the raw text."""
    return F.regexp_count(c, F.lit(TOKEN))


def tokens_no_punct(c: Column) -> Column:
    """Words with the ASCII punctuation characters deleted; a word may become empty."""
    return F.transform(tokens(c), lambda w: F.translate(w, ASCII_PUNCTUATION, ""))


def strip(c: Column) -> Column:
    """``str.strip()``: all Unicode blanks, not only the space character."""
    return F.regexp_replace(c, STRIP, "")


def drop_lines(c: Column, phrase: str | None = None) -> Column:
    """Strip each line; drop blank lines and lines holding ``phrase``; rejoin."""
    lines = F.transform(F.split(c, "\n"), strip)
    keep = F.filter(lines, lambda line: (line != "") & (~F.contains(line, F.lit(phrase)) if phrase else F.lit(True)))
    return F.array_join(keep, "\n")


def distinct_join(arr: Column, sep: str = ",") -> Column:
    """Distinct non-empty items in first-seen order, joined by ``sep``."""
    return F.array_join(F.array_distinct(F.filter(arr, lambda x: x != "")), sep)


def split_tags(c: Column, sep: str = ",") -> Column:
    """Split at a literal separator; blanks around the parts stay."""
    return F.split(c, "\\Q" + sep + "\\E")


# --- ids and names -------------------------------------------------------------------


def doc_id(number: Column, source: Column, user: Column | None = None) -> Column:
    """``00042_source`` or ``00042_source_user``; numbers over five digits stay whole."""
    parts = [number, source] + ([user] if user is not None else [])
    return F.format_string("%05d" + "_%s" * (len(parts) - 1), *parts)


def record_file_name(number: Column, source: Column, user: Column | None = None) -> Column:
    """File name of one record: its document id with ``.json``."""
    return F.concat(doc_id(number, source, user), F.lit(".json"))


def batch_file_name(name: Column, batch: Column, ext: str) -> Column:
    """First 11 characters of an id file's name, two-digit batch, extension."""
    return F.format_string("%s_%02d." + ext, F.substring(name, 1, 11), batch)


def corpus_line(id: Column, text: Column) -> Column:
    """``id<TAB>text``; a null text leaves the id and the tab."""
    return F.concat(id.cast("string"), F.lit("\t"), F.coalesce(text, F.lit("")))
