"""Text column expressions (survey 2G).  Everything is a JVM built-in
(regexp, translate, split, higher-order array functions), so a whole text
is processed inside whole-stage code generation.  The Levenshtein distance of
whole texts is the exception (:mod:`tessera.functions.edit`)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.edit import levenshtein

# Fixed values -------------------------------------------------------------
# Lower-case Vietnamese letters kept by the full clean (in alphabet order of
# their base vowel, as listed by the reference's character class).
VIET_LETTERS = "àáạảãâầấậẩẫăằắặẳẵèéẹẻẽêềếệểễòóọỏõôồốộổỗơờớợởỡìíịỉĩùúụủũưừứựửữỳýỵỷỹđ"
# ASCII punctuation replaced by a space before tokenising.
PUNCT_FILTERS = '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'
# Characters of a formula that mark it as containing an operation.
MATH_OPERATORS = "+-*/=<>"
# Character classes for ``java.util.regex``, which tests the parts of a class
# one after the other for each character of a text, except for single
# characters below 256 (one look-up).  So ASCII is listed character by
# character, and the long or slow parts stand behind a range test.
_ALNUM = "abcdefghijklmnopqrstuvwxyz0123456789"
_VIET = rf"[\x{{80}}-\x{{1EF9}}&&[{VIET_LETTERS}]]"
_WORD_CHAR = rf"[[\x{{80}}-\x{{10FFFF}}&&[\p{{L}}\p{{N}}]]{_ALNUM}{_ALNUM[:26].upper()}_]"
_PUNCT = "[" + "".join(f"\\{c}" for c in PUNCT_FILTERS) + "]"
# Word pattern of the vectorisers: runs of two or more letters/digits/_.
WORD_RE = f"{_WORD_CHAR}{_WORD_CHAR}+"
# Inline formula span \( ... \) (non-greedy, within one line).
FORMULA_RE = r"\\\(.*?\\\)"
# Display formula span \[ ... \] (the EDA variant also extracts these).
DISPLAY_RE = r"\\\[.*?\\\]"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def squeeze(col) -> Column:
    """Collapse runs of spaces and trim."""
    return F.trim(F.regexp_replace(_c(col), " {2,}", " "))


# G01 ---------------------------------------------------------------------------
def clean_full(col) -> Column:
    """lower; every char outside [a-z0-9] + Vietnamese letters → space; strip
    leading zeros of each space-separated token; squeeze; trim."""
    t = F.lower(_c(col))
    # One match per run of removed characters (runs are squeezed anyway, so
    # spaces need no match).
    t = F.regexp_replace(t, f"[^{_VIET} {_ALNUM}]+", " ")
    t = F.regexp_replace(t, "0(?<![^ ]0)0*", "")          # zeros after a space or at the start
    return squeeze(t)


# G02 ---------------------------------------------------------------------------
def clean_light(col) -> Column:
    return squeeze(F.lower(_c(col)))


# G03 ---------------------------------------------------------------------------
def clean_accent_delete(col, drop_underscore: bool = False) -> Column:
    """As the light clean, but accented Vietnamese letters are *removed*
    (not folded), optionally ``_`` too."""
    t = F.lower(_c(col))
    t = F.regexp_replace(t, f"[{_VIET}_]+" if drop_underscore else f"{_VIET}+", "")
    return squeeze(t)


# G04 ---------------------------------------------------------------------------
def clean_letters(col) -> Column:
    """Punctuation → space, digits removed, lower case."""
    t = F.regexp_replace(_c(col), _PUNCT, " ")
    t = F.regexp_replace(t, r"\d+", "")
    return F.lower(t)


def split_words(col) -> Column:
    """Whitespace tokens, empty strings dropped."""
    return F.filter(F.split(F.trim(_c(col)), r"\s+"), lambda w: w != "")


def word_tokens(col) -> Column:
    """Vectoriser tokens: runs of ≥2 word characters of the lower-cased text."""
    return F.regexp_extract_all(F.lower(_c(col)), F.lit(WORD_RE), 0)


# G06 ---------------------------------------------------------------------------
def remove_words(tokens, words: list[str]) -> Column:
    """Drop tokens found in a (small, fixed) word list."""
    stop = F.array(*[F.lit(w) for w in sorted(set(words))])
    return F.filter(_c(tokens), lambda w: ~F.array_contains(stop, w))


# G07 ---------------------------------------------------------------------------
def n_chars(col) -> Column:
    return F.length(_c(col)).cast("long")


def n_words(col) -> Column:
    return F.size(split_words(col)).cast("long")


def avg_word_len(col) -> Column:
    return F.try_divide(n_chars(col).cast("double"), F.when(n_words(col) > 0, n_words(col)))


# G13 / G14 ---------------------------------------------------------------------
def formulas(col, display: bool = False) -> Column:
    """Every ``\\( … \\)`` span (and ``\\[ … \\]`` when ``display``), in order."""
    inline = F.regexp_extract_all(_c(col), F.lit(FORMULA_RE), 0)
    if not display:
        return inline
    return F.concat(inline, F.regexp_extract_all(_c(col), F.lit(DISPLAY_RE), 0))


def strip_formulas(col, display: bool = False) -> Column:
    """The text with every formula span removed."""
    t = F.regexp_replace(_c(col), FORMULA_RE, "")
    return F.regexp_replace(t, DISPLAY_RE, "") if display else t


def has_operator(col) -> Column:
    return _c(col).rlike(r"[+\-*/=<>]")


def operator_formulas(formula_list) -> Column:
    """Keep only formulas holding an operator."""
    return F.filter(_c(formula_list), lambda f: f.rlike(r"[+\-*/=<>]"))


# G04 on the text part: the reference's "old" tokeniser ------------------------------
def text_tokens(col) -> Column:
    """Tokens of the text part: formulas removed, letters-only clean, split."""
    return split_words(clean_letters(strip_formulas(col)))


# G15 ---------------------------------------------------------------------------
def strip_latex(col) -> Column:
    """Plain tokens from LaTeX by ordered rewrites (not a parser):
    space after ``left(``/before ``right)``, drop ``\\command`` names and the
    delimiters ``\\( \\) \\[ \\]``, brackets/braces/bars → space, squeeze."""
    t = _c(col)
    t = F.regexp_replace(t, r"\\left\(", r"\\left( ")
    t = F.regexp_replace(t, r"\\right\)", r" \\right)")
    t = F.regexp_replace(t, r"\\[()\[\]]", " ")
    t = F.regexp_replace(t, r"\\[A-Za-z]+", " ")
    t = F.regexp_replace(t, r"[()\[\]{}|]", " ")
    return F.lower(squeeze(t))


# G16 ---------------------------------------------------------------------------
def text_formula_ratio(col, which: str = "text", eps: float = 1e-8) -> Column:
    """Share of characters in the cleaned text part (or the formula part)."""
    text_len = F.length(clean_letters(strip_formulas(col)))
    form_len = F.length(F.array_join(formulas(col), " "))
    num = text_len if which == "text" else form_len
    return num / (text_len + form_len + F.lit(eps))


def token_formula_ratio(col, which: str = "text", eps: float = 1e-5) -> Column:
    """Share of tokens among tokens and formulas (or of the formulas)."""
    n_text, n_form = F.size(text_tokens(col)), F.size(formulas(col))
    num = n_text if which == "text" else n_form
    return num / (n_text + n_form + F.lit(eps))


# G17 ---------------------------------------------------------------------------
def kind_parts(col) -> list[Column]:
    """Intermediate columns of the text-kind rules (project once)."""
    letters = clean_letters(strip_formulas(col))
    return [formulas(col).alias("_forms"), split_words(letters).alias("_toks"),
            (F.length(F.trim(letters)) == 0).alias("_blank")]


def text_kind_from(version: int = 2, forms="_forms", toks="_toks", blank="_blank") -> Column:
    forms, toks, blank = _c(forms), _c(toks), _c(blank)
    k = 2 if version == 2 else 1
    math_only = blank | (F.size(toks) < F.size(forms) * k) | (F.size(F.array_distinct(toks)) <= 1)
    return (F.when(F.size(forms) == 0, "Text only")
             .when(math_only, "Math only").otherwise("Math and Text"))


def text_kind_v0_from(forms="_forms", toks="_toks") -> Column:
    """G17 v0: ``Text only`` without formulas, ``Math only`` with fewer tokens
    than formulas, else ``Math and Text``."""
    forms, toks = _c(forms), _c(toks)
    return (F.when(F.size(forms) == 0, "Text only")
             .when(F.size(toks) < F.size(forms), "Math only").otherwise("Math and Text"))


def text_kind_majority_from(forms="_forms", toks="_toks") -> Column:
    """``Math only`` first (no token, fewer than two tokens a formula, or
    at most 5 tokens); then ``Text only`` without formulas or when fewer than
    half of them hold an operator (``^`` counts); else ``Math and Text``."""
    forms, toks = _c(forms), _c(toks)
    n_op = F.size(F.filter(forms, lambda f: f.rlike(r"[+\-*/=<>^]")))
    return (F.when((F.size(toks) < F.size(forms) * 2) | (F.size(toks) <= 5), "Math only")
             .when((F.size(forms) == 0) | (n_op * 2 < F.size(forms)), "Text only")
             .otherwise("Math and Text"))


# G19 ---------------------------------------------------------------------------
def non_ascii_share(col, level: str = "word") -> Column:
    """Share of words (or characters) holding a non-ASCII character, counted
    on the text without formulas in which every character that is no letter,
    digit or ``_`` is a space; -1 when there is nothing to count.  Words of
    one character and decimal numbers are skipped."""
    text = F.regexp_replace(strip_formulas(col, display=True), r"[^\p{L}\p{N}_]", " ")
    if level == "char":
        every = F.length(F.regexp_replace(text, " ", ""))
        non = F.length(F.regexp_replace(text, r"[\x00-\x7F]", ""))
    else:
        words = F.filter(split_words(text),
                         lambda w: (F.length(w) > 1) & ~w.rlike(r"^\p{Nd}+$"))
        every = F.size(words)
        non = F.size(F.filter(words, lambda w: w.rlike(r"[^\x00-\x7F]")))
    return F.when(every == 0, F.lit(-1.0)).otherwise(non / (every + F.lit(1e-9)))


# G23 ---------------------------------------------------------------------------
def pad(arr, length, value) -> Column:
    """Right-pad an array to ``length`` with ``value`` (longer arrays kept)."""
    a = _c(arr)
    n = F.greatest(F.lit(0), (length if isinstance(length, Column) else F.lit(length)) - F.size(a))
    return F.concat(a, F.array_repeat(F.lit(value), n))


# H16 / H17 / H18 ---------------------------------------------------------------------
def set_jaccard(a, b) -> Column:
    """|A ∩ B| / |A ∪ B| of two token arrays (as sets); 0 when both empty."""
    inter = F.size(F.array_intersect(_c(a), _c(b)))
    union = F.size(F.array_union(_c(a), _c(b)))
    return F.when(union == 0, F.lit(0.0)).otherwise(inter / union)


def sequence_cosine(a, b) -> Column:
    """Cosine of two numeric sequences aligned by position (the shorter is
    zero-padded); 0 when either is empty."""
    a, b = _c(a), _c(b)
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: F.coalesce(x, F.lit(0.0)) * F.coalesce(y, F.lit(0.0))),
                      F.lit(0.0), lambda acc, v: acc + v)
    na = F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, v: acc + v * v))
    nb = F.sqrt(F.aggregate(b, F.lit(0.0), lambda acc, v: acc + v * v))
    return (F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0))
             .when((na == 0) | (nb == 0), F.lit(0.0))
             .otherwise(dot / (na * nb)))


def edit_ratio(a, b, distance=levenshtein) -> Column:
    """``1 - levenshtein(a, b) / max(len)`` (1 for two empty strings), of texts
    of any length."""
    return _edit_ratio(a, b, distance)


def _edit_ratio(a, b, distance) -> Column:
    m = F.greatest(F.length(_c(a)), F.length(_c(b)))
    return F.when(m == 0, F.lit(1.0)).otherwise(1 - distance(_c(a), _c(b)) / m)


def token_sort(col) -> Column:
    return F.array_join(F.array_sort(split_words(col)), " ")


def fuzzy_parts(a, b) -> list[Column]:
    """Intermediate columns of :func:`fuzzy_from` (project them once, then
    combine): edit ratio, sorted-token strings and distinct-token sets."""
    return [edit_ratio(a, b).alias("_er"), token_sort(a).alias("_sa"), token_sort(b).alias("_sb"),
            F.array_distinct(split_words(a)).alias("_ta"), F.array_distinct(split_words(b)).alias("_tb")]


def overlap(ta, tb) -> Column:
    """``|A & B| / min(|A|, |B|)`` of two arrays of distinct tokens; 0 when one is empty."""
    inter = F.size(F.array_intersect(_c(ta), _c(tb)))
    mn = F.least(F.size(_c(ta)), F.size(_c(tb)))
    return F.when(mn == 0, F.lit(0.0)).otherwise(inter / mn)


def length_ratio(a, b) -> Column:
    """The most that :func:`edit_ratio` can be for texts of these lengths."""
    return _edit_ratio(a, b, lambda x, y: F.abs(F.length(x) - F.length(y)))


def fuzzy_from(er="_er", sa="_sa", sb="_sb", ta="_ta", tb="_tb") -> Column:
    return F.greatest(_c(er), edit_ratio(sa, sb), overlap(ta, tb))


def fuzzy_score(a, b) -> Column:
    """Re-aimed weighted fuzzy score: the best of the edit ratio, the
    edit ratio of the sorted tokens, and the token-set overlap
    ``|A ∩ B| / min(|A|, |B|)``.  For short strings inside lambdas (formulas):
    the distance is the built-in."""
    ta, tb = F.array_distinct(split_words(a)), F.array_distinct(split_words(b))
    inter = F.size(F.array_intersect(ta, tb))
    mn = F.least(F.size(ta), F.size(tb))
    overlap = F.when(mn == 0, F.lit(0.0)).otherwise(inter / mn)
    return F.greatest(_edit_ratio(a, b, F.levenshtein),
                      _edit_ratio(token_sort(a), token_sort(b), F.levenshtein), overlap)
