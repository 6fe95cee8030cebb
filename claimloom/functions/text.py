"""Text functions as column expressions: folding, tokens, similarities, identifiers, bibliographic fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words without meaning in a label (fixed values).
STOPWORDS = ["a", "an", "and", "at", "by", "for", "in", "of", "on", "or", "the", "to", "with"]
#: Head nouns that an ontology appends to classify a term (fixed values).
CLASSIFIER_NOUNS = ["process", "quality", "entity", "class", "role", "variable", "rate", "trait", "attribute", "characteristic"]
#: What an identifier looks like: a compact URI, a Wikidata item or a URL (fixed pattern).
IDENTIFIER = r"^(?:[A-Za-z][A-Za-z0-9_.]{0,30}:[A-Za-z0-9_.\-/#]+|[QP]\d+|https?://\S+)\z"
#: Plausible publication years (fixed pattern).
YEAR = r"(1[5-9]\d{2}|20\d{2}|21\d{2})"
CONTAINMENT_DISCOUNT = 0.9
SYNONYM_DISCOUNT = 0.98
_SPACE = r"(?U)\s+"


def fold(value: Column) -> Column:
    """Lower case with every run of other characters as one underscore, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(value), "[^a-z0-9]+", "_"), "^_|_$", "")


def norm(value: Column) -> Column:
    """Lower case with white space collapsed; null is empty."""
    return F.lower(F.trim(F.regexp_replace(F.coalesce(value, F.lit("")), _SPACE, " ")))


def clean_text(value: Column) -> Column:
    """Without angle-bracket markup, white space collapsed."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.coalesce(value, F.lit("")), "<[^>]+>", ""), _SPACE, " "))


def _pieces(value: Column) -> Column:
    return F.split(F.lower(F.coalesce(value, F.lit(""))), "[^a-z0-9]+")


def tokens(value: Column) -> Column:
    """Distinct ASCII words without stopwords."""
    stop = F.array(*[F.lit(x) for x in STOPWORDS])
    return F.array_distinct(F.filter(_pieces(value), lambda x: (x != "") & ~F.array_contains(stop, x)))


def title_tokens(value: Column) -> Column:
    """Distinct ASCII words of more than two characters."""
    return F.array_distinct(F.filter(_pieces(value), lambda x: F.length(x) > 2))


def plain_tokens(value: Column) -> Column:
    """Distinct ASCII words."""
    return F.array_distinct(F.array_remove(_pieces(value), ""))  # compiled, as a filter with a lambda is not


def jaccard(left: Column, right: Column) -> Column:
    """Overlap of two token sets from 0 to 1; an empty side gives 0."""
    shared = F.size(F.array_intersect(left, right))
    return F.when((F.size(left) == 0) | (F.size(right) == 0), F.lit(0.0)).otherwise(shared / (F.size(left) + F.size(right) - shared))


def containment_score(left: Column, right: Column) -> Column:
    """The larger of the overlap and the discounted share of the smaller set that the other contains."""
    n, m = F.size(left), F.size(right)
    shared = F.size(F.array_intersect(left, right))
    score = F.greatest(shared / (n + m - shared), shared / F.least(n, m) * CONTAINMENT_DISCOUNT)
    return F.when((n == 0) | (m == 0), F.lit(0.0)).otherwise(score)  # 0 without shared words, 1 for equal sets


def label_variants(label: Column) -> Column:
    """The label, and the label without a classifying last word."""
    words = F.filter(F.split(F.trim(F.coalesce(label, F.lit(""))), _SPACE), lambda x: x != "")
    nouns = F.array(*[F.lit(x) for x in CLASSIFIER_NOUNS])
    short = F.array_join(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(1))), " ")
    return F.when((F.size(words) > 1) & F.array_contains(nouns, F.lower(F.element_at(words, -1))), F.array(label, short)).otherwise(F.array(label))


def label_similarity(query: Column, label: Column) -> Column:
    """The best overlap of a query with a label's variants."""
    return F.array_max(F.transform(label_variants(label), lambda x: jaccard(tokens(query), tokens(x))))


def looks_like_identifier(value: Column) -> Column:
    return F.trim(value).rlike(IDENTIFIER)


def backoff_tails(term: Column) -> Column:
    """Tails from the second, third and fourth word on, longest first."""
    words = F.filter(F.split(F.trim(F.coalesce(term, F.lit(""))), _SPACE), lambda x: x != "")
    n = F.least(F.size(words), F.lit(4))
    tails = F.transform(F.sequence(F.lit(2), n), lambda i: F.array_join(F.slice(words, i, F.size(words)), " "))
    return F.when(n >= 2, tails).otherwise(F.array().cast("array<string>"))


def parse_year(value: Column) -> Column:
    return F.regexp_extract(value, YEAR, 1).try_cast("int")


def parse_doi(value: Column) -> Column:
    found = F.regexp_extract(value, r"10\.\d{4,9}/\S+", 0)
    return F.nullif(F.lower(F.regexp_replace(found, r"[ .,;)]+$", "")), F.lit(""))


#: Latin letters with marks and the ASCII letters that decomposition leaves of them, pairwise (fixed values).
_MARKED = "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝàáâãäåçèéêëìíîïñòóôõöùúûüýÿĀāĂăĄąĆćČčĎďĒēĖėĘęĚěĞğĪīĮįİŁłŃńŇňŌōŐőŘřŚśŞşŠšŢţŤťŪūŮůŰűŸŹźŻżŽž"
_BARE = "AAAAAACEEEEIIIINOOOOOUUUUYaaaaaaceeeeiiiinooooouuuuyyAaAaAaCcCcDdEeEeEeEeGgIiIiI\0\0NnNnOoOoRrSsSsSsTtTtUuUuUuYZzZzZz"


def slugify(value: Column, most: int = 70) -> Column:
    """ASCII words joined by underscores, cut at `most` characters; `document` if nothing is left.

    Marks are taken off Latin letters; other characters beyond ASCII are dropped before words are formed.
    """
    pairs = [(a, b) for a, b in zip(_MARKED, _BARE, strict=True) if b != "\0"]
    bare = F.translate(F.coalesce(value, F.lit("")), "".join(a for a, _ in pairs), "".join(b for _, b in pairs))
    folded = fold(F.regexp_replace(bare, r"[^\x00-\x7F]", ""))
    cut = F.regexp_replace(F.substring(folded, 1, most), "_$", "")
    return F.when(cut == "", "document").otherwise(cut)


def build_slug(author: Column, year: Column, title: Column) -> Column:
    """surname_year_first-six-title-words."""
    surname = F.when(author.isNotNull() & (author != ""), slugify(F.split(author, ",")[0], 24)).otherwise("")
    words = F.array_join(F.slice(F.split(slugify(title, 60), "_"), 1, 6), "_")
    parts = F.filter(F.array(surname, F.coalesce(year.cast("string"), F.lit("")), words), lambda x: x != "")
    return F.array_join(parts, "_")


def word_count(value: Column) -> Column:
    text = F.trim(F.regexp_replace(F.coalesce(value, F.lit("")), _SPACE, " "))
    return F.when(text == "", 0).otherwise(F.size(F.split(text, " ")))


def filename_parts(stem: Column) -> Column:
    """authors, year and title of `Author et al. - 2022 - Title`; else only a title."""
    pattern = r"^(.+?)\s+-\s+(\d{4})\s+-\s+(.+)$"
    authors = F.filter(F.transform(F.split(F.regexp_extract(stem, pattern, 1), r"\s+and\s+|,\s*"), F.trim), lambda x: (x != "") & ~F.lower(x).isin("et al", "et al."))
    hit = stem.rlike(pattern)
    return F.struct(
        F.when(hit, authors).otherwise(F.array().cast("array<string>")).alias("authors"),
        F.when(hit, F.regexp_extract(stem, pattern, 2).try_cast("int")).alias("year"),
        F.when(hit, clean_text(F.regexp_extract(stem, pattern, 3))).otherwise(clean_text(stem)).alias("title"),
    )


def local_path(value: Column) -> Column:
    """A PDF path from a link: file and internal schemes only, percent-decoded, forward slashes; else null."""
    raw = F.regexp_replace(F.trim(value), "^internal-pdf://", "")
    other = raw.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]+://") & ~F.lower(raw).startswith("file:")
    path = F.regexp_replace(F.regexp_replace(raw, r"(?i)^file:(//)?(localhost)?", ""), r"^/([A-Za-z]:)", "$1")
    decoded = F.replace(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), F.lit("\\"), F.lit("/"))
    return F.when(~other & F.lower(decoded).endswith(".pdf"), decoded)


def json_object(reply: Column) -> Column:
    """The JSON object in a model's reply: thoughts and fences removed, else from the first to the last brace."""
    text = F.trim(F.regexp_replace(F.coalesce(reply, F.lit("")), r"(?is)<think>.*?</think>", ""))
    fenced = F.regexp_extract(text, r"(?s)^```[a-zA-Z]*\s*\n?(.*?)\n?```\s*$", 1)
    text = F.when(fenced != "", F.trim(fenced)).otherwise(text)
    sliced = F.regexp_extract(text, r"(?s)(\{.*\})", 1)
    valid = lambda x: F.try_parse_json(x).isNotNull() & F.trim(x).startswith("{")
    return F.when(valid(text), text).when(valid(sliced), sliced)


#: Years and author separators of database manifests (fixed patterns).
MANIFEST_YEAR = r"(?U)\b(1[5-9]\d{2}|20\d{2})\b"
AUTHOR_BREAK = r"(?U)\s*;\s*|\s+and\s+"
#: Words in a slot's description that ask for a term identifier (fixed values).
IDENTIFIER_WORDS = ["curie", "ontology term", "accession", "identifier", "uri"]


def manifest_year(value: Column) -> Column:
    """The first year that stands as a word; null without one."""
    return F.regexp_extract(F.coalesce(value.cast("string"), F.lit("")), MANIFEST_YEAR, 1).try_cast("int")


def author_list(value: Column) -> Column:
    """Names between semicolons or the word `and`; null gives an empty list."""
    parts = F.transform(F.split(F.coalesce(value, F.lit("")), AUTHOR_BREAK), F.trim)
    return F.filter(parts, lambda x: x != "")


def safe_name(value: Column) -> Column:
    """A name that may stand in a file name; `witness` if nothing is left."""
    bare = F.btrim(F.regexp_replace(F.coalesce(value, F.lit("")), "[^A-Za-z0-9._-]+", "_"), F.lit("_"))
    return F.when(bare == "", "witness").otherwise(bare)


def shortened(value: Column, most: int) -> Column:
    """White space collapsed; a longer text is cut to `most` characters, the last of them an ellipsis."""
    text = F.trim(F.regexp_replace(F.coalesce(value, F.lit("")), _SPACE, " "))
    return F.when(F.length(text) <= most, text).otherwise(F.concat(F.rtrim(F.substring(text, 1, most - 1)), F.lit("…")))


def relative_path(path: Column, base: str) -> Column:
    """A resolved path as seen from the folder `base`; null outside it."""
    base = base.rstrip("/")
    return F.when(path == (base or "/"), ".").when(path.startswith(base + "/"), F.substring(path, len(base) + 2, 1 << 30))


def document_ref(reference: Column) -> Column:
    """The document named by a struct with document_id and doi; an empty id gives way to the DOI."""
    return F.coalesce(F.nullif(reference["document_id"], F.lit("")), reference["doi"])


def comparable_list(values: Column) -> Column:
    """A list's values normalised and sorted, for comparison without order."""
    return F.array_sort(F.transform(values, norm))


def wants_identifier(description: Column, excluded: Column) -> Column:
    """Whether a slot's description asks for a term identifier; enums, inlined classes and record ids are `excluded`."""
    words = F.lower(F.coalesce(description, F.lit("")))
    hit = F.lit(False)
    for word in IDENTIFIER_WORDS:
        hit = hit | words.contains(word)
    return hit & ~excluded
