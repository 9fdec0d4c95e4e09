"""What differs between sites: selectors, word lists, patterns. Data only."""

from __future__ import annotations

from dataclasses import dataclass

from shelfwright.functions.htmlscan import Watch


@dataclass(frozen=True)
class SiteProfile:
    brand: str
    hosts: tuple = ()
    # links
    card_class: str | None = None
    next_own: tuple = ()
    next_within: tuple = ()
    sections: tuple = ()
    topic_words: tuple = ()
    denied: tuple = ()
    product_patterns: tuple = ()
    seeds: tuple = ()
    # specifications
    table_classes: tuple | None = None
    spec_headings: tuple = ()
    # subcategory
    url_root: str | None = None
    url_stop: tuple = ()
    crumb_stop: tuple = ()
    # page reading
    classes: tuple = ()
    marked: tuple = ()
    marker: str = ""
    variant_tables: tuple = ()
    variant_row: str = "row-variant"
    article_class: str = "column-article-number"

    def watch(self) -> Watch:
        """What the page reader looks for. ``specs`` marks the tables that hold specifications."""
        specs = ("table",) if self.table_classes is None else tuple(f"table.{c}" for c in self.table_classes)
        listed = [("a", "trail")]
        if self.variant_tables:
            listed += [("th", "thead"), *((f"table.{c}", None) for c in self.variant_tables), (f".{self.article_class}", None)]
        whole = (self.variant_row,) if self.variant_tables else ()
        return Watch(self.classes, self.marked, self.marker, {"specs": specs}, listed, whole)


# ---------------------------------------------------------------------------------------
# Fixed values, site A
# ---------------------------------------------------------------------------------------
A_SUMMARY_CLASSES = ("short-description", "product-short-description", "summary", "excerpt")
A_PARAGRAPH_CLASSES = ("product-description", "description")
A_DESCRIPTION_CLASSES = (
    "product-info-description",
    "product-description",
    "long-description",
    "description",
    "product-info",
    "tab-description",
)
A_SKIP_WORDS = ("cookie", "privacy", "terms", "contact", "sitemap", "copyright", "local dealer", "standard supply")
A_NOISE_PHRASES = (
    "Local dealers",
    "Standard supply",
    "Select product version",
    "Versions available",
    "Downloads",
    "Instruction manual",
    "Spare part drawing",
    "Product data sheet",
)
A_TABLE_CLASSES = ("spec-table", "technical-data", "product-attributes", "data-table")
A_LIST_CLASSES = ("specifications", "tech-specs", "product-specs")
A_SPEC_MARKER = "Technical data"
A_LOOK_AHEAD = 20
A_SPEC_HEADING = "Technical attributes"
A_TEXT_LABELS = ("Downloads", "Instruction manual")
A_SHEET_TERMS = ("datasheet", "data sheet", "manual", "specification", "technical")
A_SHEET_URL_TERMS = ("manual", "datasheet", "spec")
A_MODEL_KEYS = ("model", "ref", "article", "item", "part", "order no")
A_IMAGE_CLASSES = ("product-image", "main-image", "woocommerce-main-image", "gallery-image")
A_IMAGE_OWN_CLASS = "product-photo"
A_NO_IMAGE_WORDS = ("logo", "icon", "sprite")
A_VARIANT_TABLES = ("accessory-variants-table", "product-variants-table")
A_ORDER_HEADERS = ("order number", "article number")
A_VARIANT_WORDS = ("diameter", "size", "dimension", "type")

SITE_A = SiteProfile(
    brand="Flex",
    hosts=("www.flex-tools.com",),
    card_class="card-link",
    next_own=("next",),
    next_within=("pagination-next",),
    seeds=("https://www.flex-tools.com/en/products", "https://www.flex-tools.com/en/accessories"),
    table_classes=A_TABLE_CLASSES,
    crumb_stop=("home", "flex-tools.com", ""),
    classes=(
        "product-name",
        "technical-data",
        "specifications",
        "product-card-grid",
        "pagination-next",
        *A_SUMMARY_CLASSES,
        *A_PARAGRAPH_CLASSES,
        *A_LIST_CLASSES,
        *A_IMAGE_CLASSES,
    ),
    marked=(
        ("product-title", "product-title", None),
        *((c, c, None) for c in A_DESCRIPTION_CLASSES),
        ("text-paragraph-content", "content", "text-paragraph-content"),
    ),
    marker=A_SPEC_MARKER,
    variant_tables=A_VARIANT_TABLES,
)

# ---------------------------------------------------------------------------------------
# Fixed values, site B
# ---------------------------------------------------------------------------------------
B_HEADINGS = ("product details", "technical data", "technical information")
B_PARAGRAPH_CLASSES = ("product-details", "content")
B_SPEC_HEADINGS = (
    "composition",
    "shelf life",
    "storage conditions",
    "density",
    "ph-value",
    "viscosity",
    "color",
    "colour",
    "packaging",
    "total chloride ion content",
)
B_DOWNLOAD_CLASSES = ("downloads", "documents", "related-documents", "#downloads")
B_MODEL_IN_SLUG = r"sika[-a-z]*-([a-z]{0,3}-?\d+[a-z]?)"
B_MODEL_IN_TEXT = r"(?:Article No\.|Product Code|Model No\.|Item No\.)"
B_DENIED = (
    "mbcc-product-integration", "about-", "contact-", "news", "media",
    "sustainability", "career", "investor", "sika-gcc", "who-we-are",
    "organization", "target-markets", "group-management", "history",
    "compliance", "purpose", "values", "brand", "strategy", "acquisition",
    "mbcc", "document-basket", "favorite-products", "search", "sitemap",
    "legal", "privacy", "cookies", "terms", "login", "register", "my-sika",
    "brochure", "software", "application", "calculator", "design",
    "knowledge-center", "bim-hub", "project-references", "overview",
    "solutions", "systems", "en.sitemap.xml", "gcc.sitemap-seo.xml",
    "download", "pdf", "jpg", "png",
)
B_PRODUCT_PATTERNS = (
    r"sika[-a-z]*-[a-z]{1,3}-\d+",
    r"sikafiber[-a-z]*-\d+",
    r"sikatard[-a-z]*-\d+",
    r"sikarapid[-a-z]*-\d+",
    r"sikacontrol[-a-z]*-\d+",
    r"sikacrete[-a-z]*-\d+",
    r"sika-\d+",
    r"sika-4a",
    r"sigunit[-_]([a-z]{1,3}-\d+)",
    r"[a-z]+-\d+[a-z]?\.(html|htm)",
    r"sikaseal[-a-z]*-\d+",
    r"sikaflex[-a-z]*-\d+",
    r"sikarep[-a-z]*-\d+",
    r"sikarep-[a-z]+",
    r"sikatop[-a-z]*-\d+",
    r"sikaemaco[-a-z]*-\d+",
    r"sika-ucrete[-a-z]*-\d+",
    r"sika-intraplast[-a-z]*",
    r"sikabond[-a-z]*",
    r"sikalatex",
    r"intracrete[-a-z]*-\d+",
    r"sika-injection[-a-z]*-\d+",
    r"sikaswell[-a-z]*",
    r"sika-carbodur[-a-z]*",
    r"sika-dust[-a-z]*",
    r"sika-cni[-a-z]*",
    r"sika-mould[-a-z]*",
    r"sikalite[-a-z]*",
    r"sika-antisol[-a-z]*",
    r"sikagard[-a-z0-9]*",
    r"sikalastic[-a-z0-9]*",
    r"sika-igolflex[-a-z0-9]*",
    r"sikadur[-a-z0-9]*",
    r"sikainject[-a-z0-9]*",
    r"sikaplan[-a-z0-9]*",
    r"sikaproof[-a-z0-9]*",
    r"sika-monotop[-a-z0-9]*",
    r"sikashield[-a-z0-9]*",
    r"sika-stabilizer[-a-z0-9]*",
    r"sika-rugasol[-a-z0-9]*",
    r"sika-separol[-a-z0-9]*",
    r"sikacem[-a-z0-9]*",
    r"sikawrap[-a-z0-9]*",
    r"sika-ferrogard[-a-z0-9]*",
    r"sika-boom[-a-z0-9]*",
    r"sikasil[-a-z0-9]*",
    r"sikahyflex[-a-z0-9]*",
    # two rules run together, so it hardly ever matches; results depend on it staying so
    r"sika-[a-z]+-\d+[a-z]?-\d+sika-[a-z]+\d+[a-z]?",
)

SITE_B = SiteProfile(
    brand="Sika",
    hosts=("gcc.sika.com", "www.gcc.sika.com", ""),
    sections=("/en/construction", "/en/industry"),
    topic_words=("construction", "concrete", "waterproofing"),
    denied=B_DENIED,
    product_patterns=B_PRODUCT_PATTERNS,
    seeds=(
        "https://gcc.sika.com/en/construction.html",
        "https://gcc.sika.com/en/construction/concrete.html",
        "https://gcc.sika.com/en/construction/waterproofing.html",
        "https://gcc.sika.com/en/construction/flooring.html",
        "https://gcc.sika.com/en/construction/sealing-bonding.html",
        "https://gcc.sika.com/en/construction/refurbishment.html",
        "https://gcc.sika.com/en/construction/roofing.html",
        "https://gcc.sika.com/en/construction/industry.html",
        "https://gcc.sika.com/en/construction/flooring-and-coating.html",
        "https://gcc.sika.com/en/construction/sealing-bonding/sealing-bonding-solutions.html",
        "https://gcc.sika.com/en/construction/refurbishment/wall-facade-system.html",
        "https://gcc.sika.com/en/construction/building-finishing/tiling-system.html",
    ),
    spec_headings=B_SPEC_HEADINGS,
    url_root="gcc.sika.com/en/",
    url_stop=("construction", "en"),
    crumb_stop=("home", "construction", "sika gcc"),
    classes=(*B_PARAGRAPH_CLASSES, *B_DOWNLOAD_CLASSES),
)
