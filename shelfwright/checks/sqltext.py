"""DuckDB spellings of the text rules, for the SQL twins only."""

SPACE = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
_IN = r"\s\x0b\x1c-\x1f\x85\p{Z}"
_MARKS = r""".,;:()\-+@#%$€£¥&*°''"/\\"""


def collapse(c):
    return f"trim(regexp_replace({c}, '{SPACE}+', ' ', 'g'), ' ')"


def strip(c):
    return f"regexp_replace({c}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def clean_ws(c):
    return collapse(f"coalesce({c}, '')")


def no_tags(c, by=""):
    return f"regexp_replace(coalesce({c}, ''), '<[^>]+>', '{by}', 'g')"


def clean_tags(c):
    return collapse(no_tags(c))


def clean_tags_space(c):
    return collapse(no_tags(c, " "))


def clean_strict(c):
    return collapse(f"regexp_replace({no_tags(c)}, '[^\\p{{L}}\\p{{N}}_{_IN}{_MARKS}]', '', 'g')")


def strip_markup(c):
    for rx in (r"(?s)<script\b.*?</script>", r"(?s)<style\b.*?</style>", "<[^>]+>"):
        c = f"regexp_replace({c}, '{rx}', '', 'g')"
    return c


def normalize_key(c):
    return f"lower({strip(f'''regexp_replace({c}, '[^\\p{{L}}\\p{{N}}_{_IN}-]', '', 'g')''')})"


def title_case(c):
    runs = rf"regexp_extract_all({c}, '\p{{L}}+|[^\p{{L}}]+')"
    return f"coalesce(array_to_string(list_transform({runs}, lambda x: CASE x[1] WHEN 'ß' THEN 'Ss' ELSE upper(x[1]) END || lower(x[2:])), ''), '')"


def unescape(c):
    """The character references that occur in the page table."""
    for ref, ch in (("&quot;?", '"'), ("&copy;?", "©"), ("&middot;?", "·"), ("&lt;?", "<"), ("&gt;?", ">"), ("&amp;?", "&")):
        c = f"regexp_replace({c}, '{ref}', '{ch}', 'g')"
    return c


def escape(c):
    """HTML text of a string; the same words in Spark SQL and DuckDB."""
    return f"replace(replace(replace({c}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
