"""Scalar functions on titles, identifiers and documents, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed


def now_iso() -> Column:
    """The time of the query in UTC."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def falsy_to_null(c: Column) -> Column:
    """Null for the empty string as well."""
    return F.when(c != "", c)


def has_text(c: Column) -> Column:
    """Neither null nor blank."""
    return F.coalesce(F.trim(c) != "", F.lit(False))


def normalize_doi(c: Column) -> Column:
    """Lower case without a resolver's address, and without `doi:` wherever it stands."""
    return F.trim(F.replace(F.regexp_replace(F.lower(F.trim(c)), r"^https?://(dx\.)?doi\.org/", ""), F.lit("doi:"), F.lit("")))


def lookup_doi(c: Column) -> Column:
    """Lower case without each of three prefixes, once and in this order; differs from normalize_doi on purpose."""
    out = F.lower(F.trim(c))
    for prefix in ("https://doi.org/", "http://doi.org/", "doi:"):
        out = F.when(out.startswith(prefix), F.substring(out, F.lit(len(prefix) + 1), F.length(out))).otherwise(out)
    return out


def normalize_title(c: Column) -> Column:
    """For identities: lower case letters, digits and single spaces."""
    return F.regexp_replace(F.regexp_replace(F.trim(F.lower(c)), r"[^a-z0-9\s]", ""), r"\s+", " ")


def title_key(c: Column) -> Column:
    """For the corpus: runs of other characters become one space."""
    return F.trim(F.regexp_replace(F.lower(c), r"[^a-z0-9]+", " "))


def title_tokens(c: Column) -> Column:
    """Distinct words of three characters or more that aren't stop words."""
    words = F.filter(F.split(F.lower(c), r"[^a-z0-9]+"), lambda t: F.length(t) >= 3)
    return F.array_except(F.array_distinct(words), F.array(*[F.lit(w) for w in fixed.TITLE_STOPWORDS]))


def canonical_id(doi: Column, corpus_id: Column, openalex_id: Column, title: Column, year: Column, author: Column) -> Column:
    """doi:, s2: or oa: with the first identifier that isn't empty, else hash: with 12 digits of title, year and author."""
    first = F.regexp_replace(F.lower(F.coalesce(author, F.lit(""))), "[^a-z]", "")
    raw = F.concat_ws("|", F.coalesce(normalize_title(title), F.lit("")), F.coalesce(year.cast("string"), F.lit("None")), first)
    return F.coalesce(
        F.concat(F.lit("doi:"), normalize_doi(falsy_to_null(doi))),
        F.concat(F.lit("s2:"), falsy_to_null(corpus_id.cast("string"))),
        F.concat(F.lit("oa:"), falsy_to_null(openalex_id)),
        F.concat(F.lit("hash:"), F.substring(F.sha1(raw), 1, 12)),
    )


def slug(c: Column, most: int = 80) -> Column:
    return F.substring(F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-+|-+$", ""), 1, most)


def neighbourhood_key(paper_id: Column, corpus_id: Column, doi: Column, arxiv: Column, title: Column) -> Column:
    """The other identity: paper id, corpus id, DOI, arXiv id, title slug."""
    return F.coalesce(
        falsy_to_null(paper_id),
        F.concat(F.lit("corpus:"), falsy_to_null(corpus_id.cast("string"))),
        F.concat(F.lit("doi:"), F.lower(falsy_to_null(doi))),
        F.concat(F.lit("arxiv:"), F.lower(falsy_to_null(arxiv))),
        F.concat(F.lit("title:"), slug(F.coalesce(title, F.lit("")))),
    )


def lookup_id(corpus_id: Column, paper_id: Column, doi: Column, corpus_prefix: str = "CorpusId:") -> Column:
    """What a paper is asked for by: corpus id, an s2: id, DOI, or a doi: id."""
    after = F.regexp_extract(paper_id, "^[^:]*:(.*)$", 1)
    return F.coalesce(
        F.concat(F.lit(corpus_prefix), falsy_to_null(corpus_id.cast("string"))),
        F.when(paper_id.startswith("s2:"), F.concat(F.lit(corpus_prefix), after)),
        falsy_to_null(doi),
        F.when(paper_id.startswith("doi:"), after),
    )


def map_key(kind: str, value: Column) -> Column:
    """An identifier as a key of the id map: its prefix and itself; DOIs in their normal form."""
    prefix = {"doi": "doi", "s2_id": "s2", "arxiv_id": "arxiv", "pubmed_id": "pubmed", "mag_id": "mag", "dblp_id": "dblp"}.get(kind, kind)
    return F.concat(F.lit(f"{prefix}:"), normalize_doi(value) if prefix == "doi" else value.cast("string"))


def _behind(prefix: str, paper_id: Column) -> Column:
    return F.when(paper_id.startswith(prefix), F.substring(paper_id, F.lit(len(prefix) + 1), F.length(paper_id)))


def expansion_lookup(paper_id: Column, doi: Column, corpus_id: Column) -> Column:
    """What the recursive expansion asks for: a doi: or s2: id first, then the paper's DOI, then its corpus id."""
    corpus = lambda c: F.concat(F.lit("CorpusId:"), falsy_to_null(c.cast("string")))
    return F.coalesce(_behind("doi:", paper_id), corpus(_behind("s2:", paper_id)), falsy_to_null(doi), corpus(corpus_id))


def citation_lookup(paper_id: Column, doi: Column, corpus_id: Column) -> Column:
    """What the limited expansion asks for: the corpus id or the DOI as they are, then an s2: or doi: id without its prefix."""
    return F.coalesce(falsy_to_null(corpus_id.cast("string")), falsy_to_null(doi), _behind("s2:", paper_id), _behind("doi:", paper_id))


def openalex_lookup(paper_id: Column, openalex_id: Column) -> Column:
    return F.coalesce(falsy_to_null(openalex_id), _behind("oa:", paper_id))


def external_id(value: Column, paper_id: Column, prefix: str) -> Column:
    """A paper's identifier of a kind, or what stands behind that prefix, in any case, in its id; empty if neither."""
    own = F.when(F.lower(paper_id).startswith(f"{prefix}:"), F.substring(paper_id, F.lit(len(prefix) + 2), F.length(paper_id)))
    return F.coalesce(falsy_to_null(value), own, F.lit(""))


def missing_metadata(title: Column, year: Column, venue: Column) -> Column:
    """A blank or missing title or venue, or a year that is missing or 0."""
    return ~has_text(title) | (F.coalesce(year, F.lit(0)) == 0) | ~has_text(venue)


def eeg_only(title: Column, abstract: Column) -> Column:
    text = F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(abstract, F.lit("")))
    return text.rlike("(?i)" + fixed.EEG_PATTERN) & ~text.rlike("(?i)" + fixed.FMRI_PATTERN)


def eeg_only_in_audit(title: Column, abstract: Column) -> Column:
    """As eeg_only with the audit's shorter pattern; what is missing reads as the word None."""
    text = F.concat_ws(" ", F.coalesce(title, F.lit("None")), F.coalesce(abstract, F.lit("None")))
    return text.rlike("(?i)" + fixed.EEG_PATTERN) & ~text.rlike("(?i)" + fixed.FMRI_AUDIT_PATTERN)


def map_values(c: Column, values: dict[str, str], default: Column) -> Column:
    pairs = [F.lit(x) for kv in values.items() for x in kv]
    return F.coalesce(F.create_map(*pairs)[c], default)


def legacy_category(c: Column) -> Column:
    return F.when(c.isNotNull(), map_values(c, fixed.LEGACY_CATEGORIES, F.lit(fixed.EXCLUDED_CATEGORY)))


def category_of_answer(c: Column) -> Column:
    """A classifier's answer as a category: codes and a renamed category are mapped, all else is out of scope."""
    answer = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    mapped = map_values(answer, fixed.CATEGORY_CODES, answer)
    return F.when(mapped.isin(*fixed.VALID_CATEGORIES), mapped).otherwise(fixed.EXCLUDED_CATEGORY)


def back_matter(heading: Column) -> Column:
    """A back-matter heading alone, or below another one; a heading below a top-level one isn't meant."""
    names = "|".join(fixed.BACK_MATTER)
    low = F.lower(heading)
    return low.isin(*fixed.BACK_MATTER) | low.rlike(f"(?s) > ({names})( > |$)")


def identity_from_path(path: Column) -> tuple[Column, Column, Column]:
    """Key, paper id and converter of a corpus path: its first directory holds an encoded DOI or S2 id."""
    directory = F.split(path, "/")[0]
    ending = F.regexp_extract(directory, r"\.([^.]*)$", 1)
    known = ending.isin(*fixed.CONVERTERS)
    name = F.when(known, F.regexp_replace(directory, r"\.[^.]*$", "")).otherwise(directory)
    doi = F.concat(F.lit("doi:"), F.lower(F.regexp_replace(F.substring(name, F.lit(5), F.length(name)), "^([^_]*)_", "$1/")))
    s2 = F.concat(F.lit("s2:"), F.lower(F.substring(name, F.lit(4), F.length(name))))
    paper_id = F.when(name.startswith("doi_10."), doi).when(name.startswith("s2_"), s2).otherwise("")
    key = F.when(paper_id != "", paper_id).otherwise(F.lower(name))
    return key, paper_id, F.when(known, ending).otherwise("unknown")


def markdown_title(text: Column, fallback: Column) -> Column:
    """The first line that isn't blank, if it is a heading of level one."""
    found = F.regexp_extract(text, r"^\s*#\s+([^\n\r]+?)\s*#*[ \t]*(?:[\n\r]|$)", 1)
    return F.when(found != "", found).otherwise(fallback)


def evidence_status(text: Column, title: Column, origin: Column) -> Column:
    """Whether a text can serve as evidence: ready, short, stub, blocked, title_mismatch or thin."""
    size, low = F.length(text), F.lower(text)
    stub = (low.contains("references & citations") & low.contains("loading...") & (size < 15_000)) | (low.contains("current browse context") & (size < 8_000))
    blocked = F.lit(False)
    for marker in fixed.BLOCKED_MARKERS:
        blocked = blocked | F.substring(low, 1, 5_000).contains(marker)
    tokens = F.array_distinct(F.filter(F.split(title_key(title), " "), lambda t: F.length(t) >= 5))

    def overlap(where: Column) -> Column:
        return F.size(F.filter(tokens, lambda t: where.contains(t))) / F.size(tokens)

    own = title_key(markdown_title(text, F.lit("")))
    strange = (F.size(tokens) >= 3) & (((markdown_title(text, F.lit("")) != "") & (overlap(own) < 0.5)) | (overlap(title_key(F.substring(text, 1, 12_000))) < 0.5))
    thin = (F.size(F.regexp_extract_all(text, F.lit(fixed.SECTION_PATTERN), F.lit(0))) < 2) & (size < 10_000)
    return (
        F.when(origin == "drive", "ready")
        .when(size < 2_000, "short")
        .when(stub, "stub")
        .when(blocked, "blocked")
        .when(strange, "title_mismatch")
        .when(thin, "thin")
        .otherwise("ready")
    )


def quality_score(text: Column, chunks: Column) -> Column:
    """Thousands of characters up to 100, 1.5 a chunk up to 40, less a quarter for each replacement character."""
    broken = F.length(text) - F.length(F.replace(text, F.lit("�"), F.lit("")))
    return F.bround(F.least(F.length(text), F.lit(100_000)) / 1_000.0 + F.least(chunks, F.lit(40)) * 1.5 - broken * 0.25, 3)


def strip_html(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, "<[^>]+>", ""))


def abstract_of(positions: Column) -> Column:
    """The text of an inverted index, a map from words to their places."""
    places = F.flatten(F.transform(F.map_entries(positions), lambda e: F.transform(e.value, lambda p: F.struct(p.alias("at"), e.key.alias("word")))))
    return F.when(F.size(places) > 0, F.array_join(F.transform(F.array_sort(places), lambda x: x.word), " "))


def venue_name(c: Column) -> Column:
    clean = F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", " "))
    return F.when(clean != "", clean).otherwise("Unknown venue")


def venue_bucket(name: Column) -> Column:
    first = F.upper(F.substring(name, 1, 1))
    return (
        F.when(name == "Unknown venue", "unknown")
        .when(first.between("A", "Z"), F.lower(first))
        .when(first.rlike(r"^\p{Nd}"), "0-9")
        .otherwise("other")
    )


def short_label(title: Column, most: int = 60) -> Column:
    return F.when(F.length(title) > most, F.concat(F.substring(title, 1, most), F.lit("..."))).otherwise(title)


def valid_identifier(c: Column) -> Column:
    clean = F.trim(c)
    return F.when(clean.rlike("^[A-Za-z0-9._/;()-]+$"), clean)


def first_link(doi: Column, arxiv: Column, pubmed: Column, pmc: Column) -> Column:
    """The address of a paper's best source."""
    return F.coalesce(
        F.concat(F.lit("https://doi.org/"), falsy_to_null(doi)),
        F.concat(F.lit("https://arxiv.org/abs/"), falsy_to_null(arxiv)),
        F.concat(F.lit("https://pubmed.ncbi.nlm.nih.gov/"), falsy_to_null(pubmed), F.lit("/")),
        F.concat(F.lit("https://pmc.ncbi.nlm.nih.gov/articles/"), falsy_to_null(pmc), F.lit("/")),
    )


def source_group(doi: Column, arxiv: Column, pubmed: Column, pmc: Column, other: Column) -> Column:
    return (
        F.when(valid_identifier(doi).isNotNull(), "doi")
        .when(valid_identifier(arxiv).isNotNull(), "arxiv")
        .when(F.coalesce(pubmed.rlike("^[0-9]+$"), F.lit(False)) | F.coalesce(pmc.rlike("(?i)^(PMC)?[0-9]+$"), F.lit(False)), "pubmed")
        .when(other.isNotNull(), "other")
        .otherwise("pending")
    )


def links_group(links: Column) -> Column:
    """The source group of a paper's links: that of the best one."""
    first = lambda *names: F.exists(links, lambda x: x.rlike(r"^\[(" + "|".join(names) + r")\]"))
    return F.when(first("DOI"), "doi").when(first("arXiv"), "arxiv").when(first("PubMed", "PMC"), "pubmed").when(F.size(links) > 0, "other").otherwise("pending")


def arxiv_number(c: Column) -> Column:
    """An arXiv number without its prefix."""
    return F.regexp_replace(F.trim(c), "^(arXiv:)?(arxiv:)?", "")


def safe_url(c: Column) -> Column:
    """http(s) addresses of plain hosts, without user, password, query or fragment."""
    return F.when(c.rlike(r"^https?://[A-Za-z0-9.-]+(:[0-9]+)?(/[^?#]*)?$"), c)


def jitter(node_id: Column, byte: int, spread: float) -> Column:
    """Two bytes of the SHA-1 of an id as an offset around 0."""
    part = F.conv(F.substring(F.sha1(node_id.cast("string")), 2 * byte + 1, 4), 16, 10).cast("double")
    return (part / 65535.0 - 0.5) * spread


def year_x(year: Column) -> Column:
    return -960.0 + ((F.greatest(F.lit(2002), F.least(year, F.lit(2026))) - 2002) / 24.0) * 1920.0
