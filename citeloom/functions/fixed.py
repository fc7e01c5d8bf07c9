"""Names, lists, patterns and thresholds that results depend on."""

# Label taxonomy.
CORE_CATEGORIES = ("fmri_gnn", "fmri_graph_classical", "fmri_geometric_manifold")
SECONDARY_CATEGORIES = ("fmri_no_graph", "graph_methods_no_fmri")
EXCLUDED_CATEGORY = "out_of_scope"
VALID_CATEGORIES = CORE_CATEGORIES + SECONDARY_CATEGORIES + (EXCLUDED_CATEGORY,)
ALL_CATEGORIES = VALID_CATEGORIES + ("uncertain",)

# Names of label tiers.
TIER_NAMES = {
    "any": 0,
    "administrative": 0,
    "haiku": 1,
    "haiku-firstpass": 1,
    "haiku-repass": 2,
    "sonnet": 3,
    "opus": 3,
    "sonnet/opus": 3,
    "trusted": 3,
}

# Old category names and their present ones; all others are out of scope.
LEGACY_CATEGORIES = {
    "fmri_gnn": "fmri_gnn",
    "brain_connectivity": "fmri_no_graph",
    "brain_network_analysis": "fmri_no_graph",
    "graph_theory_brain": "fmri_graph_classical",
    "spectral_brain": "fmri_graph_classical",
    "geometric_brain": "fmri_geometric_manifold",
    "manifold_brain": "fmri_geometric_manifold",
    "tda_brain": "fmri_geometric_manifold",
    "foundational_ml_gnn": "graph_methods_no_fmri",
    "graph_no_brain": "graph_methods_no_fmri",
    "fmri_methodology": "fmri_no_graph",
    "neuroimaging_no_graph": "fmri_no_graph",
    "psychiatric_disorders": "fmri_no_graph",
    "clinical_neuro": "fmri_no_graph",
}

# Category codes and one renamed category.
CATEGORY_CODES = {
    "1": "fmri_gnn",
    "2": "fmri_graph_classical",
    "3": "fmri_geometric_manifold",
    "4": "fmri_no_graph",
    "5": "graph_methods_no_fmri",
    "6": "out_of_scope",
    "7": "out_of_scope",
    "fmri_network_analysis": "fmri_no_graph",
}

# Words that titles are searched without.
TITLE_STOPWORDS = (
    "a", "an", "the", "of", "for", "and", "or", "to", "in", "on", "with", "via", "using", "based", "toward", "towards", "from",
    "is", "are", "be", "we", "our", "use", "new", "novel", "approach", "method", "methods", "model", "models",
    "network", "networks", "study", "analysis",
)

# Headings of back matter.
BACK_MATTER = (
    "acknowledgements",
    "acknowledgments",
    "bibliography",
    "competing interest",
    "competing interests",
    "conflict of interest",
    "credit authorship",
    "declaration of interest",
    "declaration of competing interest",
    "recommended article",
    "recommended articles",
    "references",
    "related article",
    "related articles",
)

# Converter names that end a directory name.
CONVERTERS = ("adni", "aut", "core", "epmc", "manual", "openalex", "rescue", "s2alt", "unpaywall")

# Patterns of the modality filter; the audit's second pattern has two alternatives fewer.
EEG_PATTERN = r"\b(eeg|electroencephalogra\w+|meg\b|magnetoencephalogra\w+)"
FMRI_PATTERN = r"\b(fmri|functional\s+mri|functional\s+magnetic|functional\s+connectiv\w+|bold|resting[- ]state|rs-fmri|rsfmri)"
FMRI_AUDIT_PATTERN = r"\b(fmri|functional\s+mri|functional\s+magnetic|functional\s+connectiv\w+|bold|resting[- ]state)"

# Section headings that count as structure of a paper.
SECTION_PATTERN = (
    r"(?im)^#{1,6}\s+(?:abstract|introduction|background|related work|methods?|"
    r"methodology|experiments?|results?|discussion|conclusions?|references)\b"
)
HEADING_PATTERN = r"^(#{1,6})\s+(.+?)\s*#*$"

# Markers of blocked pages.
BLOCKED_MARKERS = ("access denied", "just a moment...", "captcha", "403 forbidden")

# Layout geometry.
LANES = {"fmri_gnn": 620.0, "fmri_geometric_manifold": 0.0, "fmri_graph_classical": -620.0}
CONSTELLATIONS = {"fmri_graph_classical": (-430.0, 0.0), "fmri_gnn": (610.0, 350.0), "fmri_geometric_manifold": (620.0, -470.0)}
#: Fixed: side of the force layout's box and radius of the circle of isolates; height of a lane, growth of a spiral, height of
#: the map by citations; jitter (x, y) by layout; the least size of a node and what the best connected one has more (file, web).
LAYOUT_SPAN, ISOLATE_RADIUS = 1800.0, 1050.0
LANE_HEIGHT, SPIRAL_STEP, IMPACT_HEIGHT = 470, 7.6, 1380
JITTER = {"timeline": (48, 7), "impact": (42, 15)}
NODE_SIZES = {"size": (2.0, 12.0), "web_size": (1.4, 5.6)}
CATEGORY_HEADINGS = {
    "fmri_gnn": "Graph and geometric deep learning",
    "fmri_geometric_manifold": "Geometric, manifold, and topological methods",
    "fmri_graph_classical": "Classical graph analysis",
}
SOURCE_GROUPS = {"doi": "DOI", "arxiv": "arXiv", "pubmed": "PubMed or PMC", "other": "Other stable source", "pending": "Source link pending"}

# Identifiers with the addresses of their pages (name, pattern, address before and behind), in order.
IDENTIFIER_PATTERN = r"[A-Za-z0-9._/;()-]+"
SOURCE_LINKS = (
    ("DOI", IDENTIFIER_PATTERN, "https://doi.org/", ""),
    ("arXiv", IDENTIFIER_PATTERN, "https://arxiv.org/abs/", ""),
    ("PMC", "[0-9]+", "https://pmc.ncbi.nlm.nih.gov/articles/PMC", "/"),
    ("PubMed", "[0-9]+", "https://pubmed.ncbi.nlm.nih.gov/", "/"),
)

# Hosts whose pages an identifier leads to.
SOURCE_HOSTS = {
    "doi.org": "DOI",
    "dx.doi.org": "DOI",
    "arxiv.org": "arXiv",
    "www.arxiv.org": "arXiv",
    "ncbi.nlm.nih.gov": "PMC",
    "www.ncbi.nlm.nih.gov": "PMC",
    "pmc.ncbi.nlm.nih.gov": "PMC",
}

# File names of source groups, and names of the venue groups that aren't letters.
SOURCE_PAGES = {"doi": "doi", "arxiv": "arxiv", "pubmed": "pubmed-pmc", "other": "other", "pending": "pending"}
VENUE_GROUPS = {"0-9": "0–9 / symbols", "other": "Other", "unknown": "Unknown"}

# Columns of released nodes.
RELEASE_COLUMNS = ("paper_id", "title", "year", "venue", "category", "doi", "arxiv", "pubmed", "pmc", "citation_count")
