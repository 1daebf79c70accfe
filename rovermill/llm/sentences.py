"""Sentences of texts in any script, in SQL expressions only.

Periods that end nothing (decimals, file names, addresses, initials, abbreviations, list numbers) and terminators inside a
quotation that its sentence goes on after are masked by private-use characters, one for one, so all offsets stay. Boundary
marks are then put in at zero-width matches of terminator patterns per script, the text is split at them, and offsets follow
from the lengths of the parts; the sentence text itself is cut from the unmasked text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rovermill.runtime import spread

DOT, CUT, HELD, PARAGRAPH = "\ue000", "\ue001", "\ue002", "\ue003"
#: What stands for these four while a text that holds them is read; as private, and no mark.
FOREIGN = "\uf8f0"

#: White space in and around sentences, beyond what \s covers; and that within a line.
W = r"[\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"
BLANK = r"[ \t\x{A0}\x{202F}\x{2000}-\x{200A}\x{3000}\x{FEFF}]"
CLOSE = r"[\"”“»’'\)\]）」』】》〉]"
# Terminators of further scripts, which end a sentence wherever they stand (Armenian, Syriac, Ethiopic, Canadian,
# Philippine, Khmer, Mongolian, Limbu, Tai Tham, Balinese, Lepcha, Ol Chiki, Burmese, Tibetan, Coptic, Lisu, Vai, Bamum, Phags-pa,
# Saurashtra, Kayah Li, Javanese, Cham, Meetei Mayek).
OTHER = r"\x{589}\x{700}-\x{702}\x{F0D}-\x{F11}\x{104B}\x{1362}\x{1367}\x{1368}\x{166E}\x{1735}\x{1736}\x{17D4}\x{17D5}\x{1803}\x{1809}\x{1944}\x{1945}\x{1AA8}-\x{1AAB}\x{1B5E}\x{1B5F}\x{1C3B}\x{1C3C}\x{1C7E}\x{1C7F}\x{2CF9}\x{2CFE}\x{A4FF}\x{A60E}\x{A60F}\x{A6F3}\x{A6F7}\x{A876}\x{A877}\x{A8CE}\x{A8CF}\x{A92F}\x{A9C9}\x{AA5D}-\x{AA5F}\x{AAF0}\x{AAF1}\x{ABEB}"
STOPS = r".!?…。！？｡।॥؟۔" + OTHER

# Abbreviations by language. Titles and short forms after which the sentence goes on.
INNER = {
    "en": ["Dr", "Mr", "Mrs", "Ms", "Prof", "St", "Lt", "Col", "Gen", "Capt", "Sgt", "Rev", "Hon", "No", "Nos", "Sec", "Fig", "Figs", "Eq", "Ch", "Vol", "Ed", "approx", "Approx", "e.g", "i.e", "vs", "cf", "Cf", "al", "Inc", "Ltd", "Corp", "Co", "Jr", "Sr", "Mt", "Ave", "Dept", "fig", "viz", "Adm", "Gov", "Sen", "Rep", "Maj", "Cmdr", "Pres", "Messrs", "Blvd", "Hwy"],
    "de": ["Nr", "ca", "Hrn", "Hr", "Fr", "Abb", "Tab", "bzw", "z", "d", "u", "o", "v", "sog", "vgl", "Vgl", "Str", "evtl", "ggf", "inkl", "S", "Bd", "zzgl", "Kap", "Dipl", "Ing"],
    "fr": ["M", "MM", "Mme", "Mlle", "env", "p", "pp", "ex", "c.-à-d", "c.-à-d", "art", "chap", "n", "éd", "éd", "av"],
    "es": ["Sr", "Sra", "Srta", "Dra", "D", "Dña", "Dña", "pág", "pág", "págs", "aprox", "ej", "núm", "núm", "cap", "Ud", "Uds", "EE"],
    "ru": ["рис", "стр", "с", "см", "См", "прим", "напр", "т", "г", "гг", "ул", "им", "гл", "проф", "акад", "тов", "п"],
    "el": ["κ", "κα", "βλ", "Βλ", "π.χ", "σ", "σελ", "αρ", "δηλ", "εικ", "Δρ", "κ.ά"],
    "it": ["sig", "sigg", "dott", "pag", "pagg", "avv"],
    "pl": ["prof", "dr", "mgr", "inż", "ul", "np", "tzn", "nr", "godz", "płk"],
    "nl": ["dhr", "mevr", "bijv", "blz", "d.w.z"],
    "pt": ["Exmo", "Exma", "pág", "tel"],
    "sv": ["t.ex", "bl.a", "s.k"],
    "hi": ["डॉ", "सं", "श्री", "प्रो", "पृ"],
    "ar": ["د", "ص", "رقم"],
}
# Short forms that may also be the last word; the sentence goes on if a small letter (of no identifier) or punctuation follows.
EITHER = ["etc", "p.m", "a.m", "usw", "u.a", "д", "пр", "др", "е", "к", "μ", "χλμ", "κ.λπ", "κτλ", "π.μ", "μ.μ", "sq", "h", "B", "ecc", "itd", "itp", "enz", "osv"]
# Short forms only before a number; else an ordinary word.
COUNTED = ["no", "sec", "min", "max"]


def _any(words: list[str]) -> str:
    return "|".join(sorted({w.replace(".", r"[.]") for w in words}, key=lambda w: (-len(w), w)))


_NO_LETTER = r"(?<![\p{L}\p{M}\p{N}_])"
_MARK = BLANK + r"*+\p{N}{1,3}"

#: What makes a period end nothing; all of them are tried at each period, in one pass.
DOT_RULES = [
    # decimals, versions, file names, addresses, dotted short forms; a small letter before a capital is a missing space
    r"(?=[\p{Ll}\p{N}_])(?<=[\p{L}\p{M}\p{N}_\-/]\.)",
    r"(?=\p{Lu})(?<=[\p{Lu}\p{N}_\-/]\.)",
    r"(?=\p{N})",
    # abbreviations, initials, ordinals of German dates and days
    r"(?<=" + _NO_LETTER + "(?:" + _any([w for ws in INNER.values() for w in ws]) + r")\.)(?=" + W + r"*[^\s])",
    r"(?<=" + _NO_LETTER + "(?:" + _any(EITHER) + r")\.)(?=" + W + r"*(?!\p{Ll}+_)[\p{Ll},;:])",
    r"(?=" + W + r"*\p{N})(?<=" + _NO_LETTER + "(?:" + _any(COUNTED) + r")\.)",
    r"(?=" + W + r"*\p{Lu})(?<=" + _NO_LETTER + r"\p{Lu}\.)(?<!\p{N}" + W + r"\p{Lu}\.)",
    r"(?=" + W + r"+\p{Lu})(?<=\p{N}\.)(?<=(?:[AaIi]m|[Vv]om|[Zz]um|[Bb]eim|[Dd](?:er|en|em|ie|as))" + W + r"\p{N}{1,3}\.)",
]
#: Numbers that head a line of a list or a heading: after a blank line, or after another numbered line, however long (\G: from
#: the number masked before).
NUMBER = r"(?:\G|(?=\n))((?:^\n?|\n" + BLANK + r"*+\n)" + _MARK + r"|(?:(?:^|\n)" + _MARK + r"[.\x{E000})](?=" + BLANK + r")|(?!^)\G)[^\n]*+\n" + _MARK + r")\.(?=" + BLANK + ")"
OPENING, CLOSING = "“«「『„", "”»」』“"
#: All of them, as few ranges.
_QUOTES = r"\x{AB}\x{BB}\x{201C}-\x{201E}\x{300C}-\x{300F}"

#: A mark that closes »so« opens nothing.
_CLOSED = r"[\p{L}\p{N}.!?…,]«"


def masked(docs: DataFrame) -> DataFrame:
    """Adds masked: text with its non-final periods and quoted terminators masked; as long as text, code point by code point."""
    ends = r"\r\x0B\x0C\x{85}\x{2028}\x{2029}"
    rows = docs.withColumn("masked", F.replace("text", F.lit("\r\n"), F.lit(" \n")))
    rare = F.regexp_replace(F.regexp_replace("masked", f"[{DOT}-{PARAGRAPH}]", FOREIGN), f"[{ends}]", "\n")
    t = F.when(F.col("masked").rlike(f"[{ends}{DOT}-{PARAGRAPH}]"), rare).otherwise(F.col("masked"))
    t = F.regexp_replace(t, r"\.(?:" + "|".join(DOT_RULES) + ")", DOT)
    t = F.regexp_replace(t, NUMBER, "$1" + DOT)
    rows = rows.withColumn("masked", t)
    # terminators in quotations that close before the next blank line, from the opening mark on (\G: from the one masked
    # before); the last one of a quotation stays if a capital begins the next sentence
    t = F.regexp_replace("masked", rf"\n(?={BLANK}*+\n)", PARAGRAPH)
    last = rf"(?![{STOPS}]*+{W}?[{CLOSING}](?:{W}|{PARAGRAPH})+\p{{Lu}})"
    to_stop, to_close = rf"[^{_QUOTES}{STOPS}{PARAGRAPH}]*+", rf"[^{_QUOTES}{PARAGRAPH}]*+"
    opened = rf"[{OPENING}](?<!{_CLOSED})(?!(?<=“)(?:{W}|[,.;:!?\)]))(?={to_close}[{CLOSING}])"
    t = F.regexp_replace(t, rf"(?:\G|(?=[{OPENING}]))((?:{opened}|(?!^)\G){to_stop}){last}[{STOPS}]", "$1" + HELD)
    return rows.withColumn("masked", F.when(F.col("masked").rlike(f"[{OPENING}]"), F.replace(t, F.lit(PARAGRAPH), F.lit("\n"))).otherwise(F.col("masked")))


#: What may follow white space after a terminator: no small letter (but for an identifier such as rpm_1), no mark that goes on.
#: Nor a picture sign that stands before the real terminator.
_NEXT = r"(?=" + W + r"+(?:(?!" + W + r"|[\p{Ll},;:)»”—]|[\p{So}\p{Sk}\p{Cf}\x{FE0F}]++[.!?…])|(?=\p{Ll}+_)))"
#: Each boundary comes after the text matched; every pattern begins with the character that ends a line or a sentence, and all are
#: tried there in one pass.
BOUNDARIES = [
    # a blank line; the start of a list item, numbered line or chat line
    r"(?=[\n\p{Po}])(?:\n(?=" + BLANK + r"*+(?:\n|[-*•‣▪]" + BLANK + r"+\S|\[[\p{N}:. ]{3,}+\]|\p{N}{1,3}[\x{E000})]" + BLANK + "))",
    # alphabets with spaces: terminator, closing marks, white space or a missing one
    r"[.!?…؟۔]" + CLOSE + "*+" + _NEXT,
    r"(?<=\p{Ll})[.](?=\p{Lu})",
    r"[।॥]" + CLOSE + "*+(?=" + W + ")",
    # scripts without spaces
    r"[。！？｡][”’\)\]）」』】》〉]*+(?![" + STOPS + r"]|$)",
    r"[!?…][”’\)\]）」』】》〉]*+(?=[\p{IsHan}\p{IsHiragana}\p{IsKatakana}（「『])",
    "[" + OTHER + "]++" + CLOSE + "*+(?![" + STOPS + "]))",
    # Thai: a space between two letters
    r"[\x{E01}-\x{E4E}](?=" + W + r"+[\x{E01}-\x{E4E}])",
]
#: Greek question mark: a semicolon of a stretch that holds a Greek letter.
_STRETCH = r"[^.!?;\n\x{37E}]"
GREEK = rf"((?<!{_STRETCH})(?={_STRETCH}*?[\x{{370}}-\x{{3FF}}\x{{1F00}}-\x{{1FFF}}&&\p{{L}}]){_STRETCH}*+[;\x{{37E}}]{CLOSE}*+)(?={W}+[^\p{{Ll}}\s])"


def marked(docs: DataFrame) -> DataFrame:
    """masked with a boundary mark after every sentence."""
    rows = masked(docs)
    rows = rows.withColumn("masked", F.regexp_replace("masked", "(" + "|".join(BOUNDARIES) + ")", "$1" + CUT))
    greek = F.contains("masked", F.lit(";")) | F.contains("masked", F.lit("\u037e"))
    return rows.withColumn("masked", F.when(greek, F.regexp_replace("masked", GREEK, "$1" + CUT)).otherwise(F.col("masked")))


#: Characters of W, for trimming.
_SPACES = " \t\n\x0b\x0c\r\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000\ufeff" + "".join(map(chr, range(0x2000, 0x200B)))
#: Parts folded at a time: a fold copies what it has at each step, so that one fold of n parts would cost n squared.
BLOCK = 128


def sentences(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """doc_id, sent_idx, sent_start, sent_end (0-based code points, end exclusive) and sentence text of every document.

    docs: doc_id, text; other columns are ignored. Null and blank texts give no rows; a text without any terminator is one
    sentence. Outer white space belongs to no sentence. Rows that repeat a doc_id are read as they come.
    """
    parts = marked(spread(docs.select("doc_id", "text").where("text is not null"), "doc_id", "text")).withColumn("parts", F.split("masked", CUT)).drop("masked")
    size = F.transform("parts", lambda p: F.struct(F.length(p).alias("n"), (F.length(p) - F.length(F.ltrim(p, F.lit(_SPACES)))).alias("lead"), F.length(F.trim(p, F.lit(_SPACES))).alias("body")))
    rows = parts.withColumn("size", size).drop("parts")
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size("size") - 1) / BLOCK).cast("int")), lambda b: F.slice("size", b * BLOCK + 1, F.lit(BLOCK)))
    span = lambda acc, p: F.struct((acc["at"] + p["lead"]).alias("s"), (acc["at"] + p["lead"] + p["body"]).alias("e"))
    step = lambda acc, p: F.struct((acc["at"] + p["n"]).alias("at"), F.when(p["body"] > 0, F.array_append(acc["out"], span(acc, p))).otherwise(acc["out"]).alias("out"))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<s:int,e:int>>").alias("out"))
    rows = rows.withColumn("folds", F.transform(blocks, lambda b: F.aggregate(b, zero, step))).drop("size")
    # where each block begins, then its spans from there; the text of a block is cut out once
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
    starts = F.aggregate("folds", begin, lambda acc, f: F.struct((acc["at"] + f["at"]).alias("at"), F.array_append(acc["out"], acc["at"]).alias("out")))["out"]
    text = lambda f, s: F.substring(F.col("text"), s + 1, f["at"]) if with_text else F.lit("")
    rows = rows.withColumn("blocks", F.zip_with("folds", starts, lambda f, s: F.struct(f["out"].alias("out"), s.alias("s"), text(f, s).alias("t")))).drop("folds", "text")
    cut = lambda b, p: F.struct((b["s"] + p["s"]).alias("s"), (b["s"] + p["e"]).alias("e"), *([F.substring(b["t"], p["s"] + 1, p["e"] - p["s"]).alias("t")] if with_text else []))
    spans = F.flatten(F.transform("blocks", lambda b: F.transform(b["out"], lambda p: cut(b, p))))
    out = rows.select("doc_id", F.posexplode(spans).alias("sent_idx", "span"))
    cols = ["doc_id", F.col("sent_idx").cast("long").alias("sent_idx"), F.col("span.s").cast("long").alias("sent_start"), F.col("span.e").cast("long").alias("sent_end")]
    return out.select(*cols, F.col("span.t").alias("sentence")) if with_text else out.select(*cols)
