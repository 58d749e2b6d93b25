"""Fixed values of the codebook.

Everything in this module is a value that results must agree with: word
lists, label tables, column orders, text patterns and version strings. There
is no logic here. Order matters where a table is read "first hit wins".
"""

# --- fixed values: versions and constants ---------------------------------
ANNOTATION_VERSION = "scd-codebook-2024-1-v1"
DOI_VERSION = "10.5281/zenodo.11092977"
EXTRACTION_VERSION = "v1"
PAGE_SELECTOR = "#highlight_content > .content"
PARAGRAPH_SELECTOR = "div.para"
DISCOVERY_SOURCE = "bger"
DISCOVERY_LANGUAGE = "de"
DISCOVERY_COURT = "BGer"

# --- fixed values: column orders ------------------------------------------
CODEBOOK_COLUMNS = (
    "docref",
    "url",
    "date",
    "year",
    "proc_type",
    "merged_cases",
    "division",
    "division_type",
    "n_judges",
    "language",
    "length",
    "area_general",
    "area_intermediate",
    "area_detailed",
    "topic",
    "issue",
    "source_date",
    "source_canton",
    "proc_duration",
    "app_class",
    "app_represented",
    "resp_class",
    "resp_represented",
    "outcome",
    "outcome_binary",
    "cited_bger",
    "n_cited_bger",
    "cited_bge",
    "n_cited_bge",
    "leading_case",
    "doi_version",
)
AUDIT_COLUMNS = (
    "html_id",
    "raw_html_path",
    "annotation_version",
    "model_name",
    "warnings",
)
WARNED_FIELDS = ("docref", "date", "n_judges", "issue", "source_date", "outcome")
AMBIGUOUS_FIELDS = ("area_detailed", "app_class", "resp_class", "outcome")
REPLY_FIELDS = (
    "area_detailed",
    "area_intermediate",
    "area_general",
    "app_class",
    "resp_class",
    "outcome",
)

# --- fixed values: comparison ---------------------------------------------
COMPARE_KEYS = ("docref", "date")
TRUTH_INDEX_COLUMNS = ("Unnamed: 0", "_c0")
MISSING_TOKENS = ("", "NA", "NaN", "nan", "<NA>")
CSV_MISSING_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)
MISSING_TRUTH_FIELD = "__missing_ground_truth__"

# --- fixed values: registry -----------------------------------------------
DOWNLOADED_STATUSES = ("downloaded", "already_exists")
ERROR_STATUS = "error"
LINK_MARKERS = ("type=show_document", "highlight_docid")
LINK_ID_PARAMETER = "highlight_docid"
LINK_DROPPED_TITLE = "publiziert"

# --- fixed values: text patterns ------------------------------------------
CASE_PATTERN = r"\b([1-9][A-Z][_.]\d+/\d{4})\b"
DOCID_PATTERN = r"([1-9][A-Z][_.]\d+)-(\d{4})$"
REPORT_CITATION_PATTERN = r"\b(?:BGE|ATF|DTF)\s+(\d{3,4}\s+[IVX]+\s+\d+)\b"
LEADING_CASE_PATTERN = r"\bBGE\s+(\d{3,4}\s+[IVX]+\s+\d+)\b"
NUMERIC_DATE_PATTERN = r"\b(\d{1,2})[./](\d{1,2})[./](\d{2,4})\b"
TEXT_DATE_PATTERN = r"\b(\d{1,2})(?:er|\.)?\s+([A-Za-zÀ-ÿ]+)\s+(\d{4})\b"
VERSUS_PATTERN = r"\b(?:gegen|contre|contro)\b"
PROCEDURAL_CUT_PATTERN = r"\b(?:nach einsicht|in erwägung|vu\s*:|visto|considerando)\b"
ENUMERATOR_PATTERN = r"[A-Z]\.|[0-9]+\.?"
COMPANY_SUFFIX_PATTERN = r"(?:\b|_+)(?:ag|gmbh|sa|sàrl|sarl|llc|ltd|inc)\b"
CLERK_TAIL_PATTERN = r"(Gerichtsschreiber(?:in)?|Greffi(?:er|ère)|cancellier[aeo]?|cancelliera).*"
JUDGE_TITLE_PATTERN = (
    r"(?:\b(?:Bundesrichter(?:in|innen)?|Juge(?:s)? fédér(?:al|aux|ale|ales)|Juges?"
    r"|Giudic[ei] federal[ei]|Mme|Mmes|M)\b\.?|\bMM\.)"
)
PRESIDENT_PATTERN = (
    r"\b(président de la Cour|presidente della Corte|präsidierendes Mitglied"
    r"|membre présidant|Präsident(?:in)?|président(?:e)?|presidente)\b"
)
SUBSTITUTE_PATTERN = (
    r"\b(giudice supplente|juge suppléant|juge suppléante|suppléant|suppléante|supplente)\b"
)
NAME_CONJUNCTIONS = (" und ", " et ", " e ")
NAME_ARTICLE_PATTERN = r"^(?:les|le|la|gli|i)\s+"
CLERK_NAME_PATTERN = r"gerichtsschreiber|greffi|cancell"

# --- fixed values: section markers ----------------------------------------
COMPOSITION_MARKERS = ("besetzung", "composition", "composizione")
SUBJECT_MARKERS = ("gegenstand", "objet", "oggetto")
PARTY_MARKERS = (
    "parteien",
    "parties",
    "parti",
    "verfahrensbeteiligte",
    "participants",
    "participants à la procédure",
)
COMPOSITION_STOPS = (
    "parteien",
    "parties",
    "parti",
    "beteiligte",
    "participants",
    "participants à la procédure",
    "oggetto",
    "objet",
    "gegenstand",
)
SUBJECT_STOPS = (
    "sachverhalt",
    "faits",
    "fatti",
    "erwägung",
    "considérant",
    "considerando",
    "das bundesgericht zieht",
    "le tribunal fédéral considère",
    "le président de la",
    "la présidente de la",
    "il presidente della",
    "la presidente della",
    "nach einsicht",
    "in erwägung",
    "vu:",
    "vu ",
    "visto",
    "diritto",
)
DECISION_DATE_MARKERS = ("urteil vom", "arrêt du", "sentenza del")
HOLDING_MARKERS = (
    "demnach erkennt",
    "par ces motifs",
    "per questi motivi",
    "erkennt das bundesgericht",
)
LANGUAGE_MARKERS = (
    ("fr", ("arrêt du", "objet", "parties")),
    ("it", ("sentenza del", "oggetto", "parti")),
    ("de", ("urteil vom", "gegenstand", "parteien")),
)

# --- fixed values: parties ------------------------------------------------
STATE_TERMS = (
    "kanton",
    "gemeinde",
    "regierungsrat",
    "verwaltungsgericht",
    "staatsanwaltschaft",
    "bundesanwaltschaft",
    "bundeskriminalpolizei",
    "departement",
    "amt",
    "office",
    "tribunal",
    "conseil d'etat",
    "conseil d'état",
    "consiglio di stato",
    "ministère public",
    "procureur général",
    "procureure générale",
    "police",
    "service de",
)
LEGAL_TERMS = (
    "stiftung",
    "association",
    "verein",
    "inc.",
    "ltd",
    "versicherung",
    "assurance",
    "bank",
)
LAWYER_TERMS = (
    "rechtsanwalt",
    "rechtsanwältin",
    "anwalt",
    "avocat",
    "avocate",
    "avvocato",
    "avvocatessa",
    " me ",
)

# --- fixed values: outcomes (first hit wins) ------------------------------
OUTCOME_TERMS = (
    (
        "partly granted",
        (
            "teilweise gutheissung",
            "teilweise gutgeheissen",
            "partiellement admis",
            "parzialmente accolto",
        ),
    ),
    (
        "inadmissible",
        (
            "nicht eingetreten",
            "nicht einzutreten",
            "n'entre pas en matière",
            "irrecevable",
            "inammissible",
            "inammissibile",
            "non entra nel merito",
        ),
    ),
    ("granted", ("wird gutgeheissen", "recours est admis", "ricorso è accolto")),
    ("rejected", ("wird abgewiesen", "recours est rejeté", "ricorso è respinto")),
    (
        "writeoff",
        (
            "verfahren wird abgeschrieben",
            "als gegenstandslos abgeschrieben",
            "cause est rayée du rôle",
            "rayé du rôle",
            "stralciata",
            "stralciato",
        ),
    ),
)
OUTCOMES_TRUE = ("granted", "partly granted")
OUTCOMES_FALSE = ("inadmissible", "rejected")

# --- fixed values: procedure letters --------------------------------------
PROCEDURE_TYPES = {
    "A": "Civil",
    "B": "Criminal",
    "C": "Public",
    "D": "Constitutional",
    "E": "Action",
    "F": "Revision",
    "G": "Correction",
}

# --- fixed values: month names --------------------------------------------
MONTHS = {
    "januar": 1, "janvier": 1, "gennaio": 1,
    "februar": 2, "février": 2, "fevrier": 2, "febbraio": 2,
    "märz": 3, "maerz": 3, "mars": 3, "marzo": 3,
    "april": 4, "avril": 4, "aprile": 4,
    "mai": 5, "maggio": 5,
    "juni": 6, "juin": 6, "giugno": 6,
    "juli": 7, "juillet": 7, "luglio": 7,
    "august": 8, "août": 8, "aout": 8, "agosto": 8,
    "september": 9, "septembre": 9, "settembre": 9,
    "oktober": 10, "octobre": 10, "ottobre": 10,
    "november": 11, "novembre": 11,
    "dezember": 12, "décembre": 12, "decembre": 12, "dicembre": 12,
}

# --- fixed values: divisions by first digit of the docket, from the day of their name on ---
DIVISIONS = {
    "1": (("", "1. Public"),),
    "2": (("", "2. Public"),),
    "4": (("", "1. Civil"),),
    "5": (("", "2. Civil"),),
    "6": (("2023-07-01", "1. Criminal"), ("", "Criminal")),
    "7": (("2023-07-01", "2. Criminal"), ("", "Criminal")),
    "8": (("2023-01-01", "4. Public"), ("", "1. Social")),
    "9": (("2023-01-01", "3. Public"), ("", "2. Social")),
}
DIVISION_TYPES = (("Civil", ("Civil",)), ("Criminal", ("Criminal",)), ("Public", ("Public", "Social")))

# --- fixed values: source courts (federal first, then cantons in order) ---
FEDERAL_SOURCE = "CH"
FEDERAL_SOURCE_TERMS = (
    "bundesverwaltungsgericht",
    "bundesstrafgericht",
    "bundespatentgericht",
    "tribunal administratif fédéral",
    "tribunal pénal fédéral",
    "tribunale amministrativo federale",
    "tribunale penale federale",
)
CANTON_TERMS = {
    "ZH": ("zürich", "zurich"),
    "BE": ("bern", "berne"),
    "LU": ("luzern", "lucerne"),
    "UR": ("uri",),
    "SZ": ("schwyz",),
    "OW": ("obwalden",),
    "NW": ("nidwalden",),
    "GL": ("glarus",),
    "ZG": ("zug",),
    "FR": ("freiburg", "fribourg"),
    "SO": ("solothurn", "soleure"),
    "BS": ("basel-stadt", "bâle-ville", "basilea-città"),
    "BL": ("basel-landschaft", "bâle-campagne", "basilea-campagna"),
    "SH": ("schaffhausen",),
    "AR": ("appenzell ausserrhoden", "appenzell rhodes-extérieures"),
    "AI": ("appenzell innerrhoden", "appenzell rhodes-intérieures"),
    "SG": ("st. gallen", "st. gall", "saint-gall", "san gallo"),
    "GR": ("graubünden", "grisons", "grigioni"),
    "AG": ("aargau", "argovie"),
    "TG": ("thurgau", "thurgovie", "turgovia"),
    "TI": ("ticino", "tessin"),
    "VD": ("vaud",),
    "VS": ("wallis", "valais"),
    "NE": ("neuchâtel", "neuenburg"),
    "GE": ("genève", "geneva", "genf", "ginevra"),
    "JU": ("jura",),
}

# --- fixed values: legal areas (first hit wins) ---------------------------
AREA_TERMS = {
    "Berufliche Vorsorge": ("berufliche vorsorge", "bvg", "prévoyance professionnelle"),
    "Invalidenversicherung": ("invalidenversicherung", "iv-stelle", "assurance-invalidité"),
    "Alters- und Hinterlassenenversicherung": (
        "alters- und hinterlassenenversicherung",
        "ahv",
        "avs",
        "assurance-vieillesse",
    ),
    "Ergänzungsleistung": (
        "ergänzungsleistung",
        "prestations complémentaires",
        "prestazione complementare",
    ),
    "Unfallversicherung": ("unfallversicherung", "suva", "assurance-accidents"),
    "Krankenversicherung": ("krankenversicherung", "assurance-maladie"),
    "Arbeitslosenversicherung": ("arbeitslosenversicherung", "assurance-chômage"),
    "Bürgerrecht und Ausländerrecht": (
        "aufenthaltsbewilligung",
        "niederlassungsbewilligung",
        "ausländerrecht",
        "permesso di dimora",
        "autorisation de séjour",
        "autorisation d'établissement",
        "regroupement familial",
        "droit des étrangers",
        "naturalisation",
        "einbürgerung",
    ),
    "Schuldbetreibungs- und Konkursrecht": (
        "schuldbetreibung",
        "konkurs",
        "poursuite",
        "faillite",
        "mainlevée",
        "rechtsöffnung",
    ),
    "Strafprozess": (
        "strafprozess",
        "strafverfahren",
        "untersuchungshaft",
        "beschlagnahme",
        "procédure pénale",
        "détention provisoire",
        "détention pour des motifs de sûreté",
        "séquestre",
    ),
    "Strafrecht (allgemein)": (
        "strafrecht (allgemein)",
        "allgemeiner teil des strafrechts",
    ),
    "Straftaten": (
        "stgb",
        "strafrecht",
        "infraction",
        "reato",
        "lcr",
        "irreführung der rechtspflege",
        "geldwäscherei",
        "urkundenfälschung",
    ),
    "Familienrecht": (
        "ehescheidung",
        "eheschutz",
        "eheliche gemeinschaft",
        "kindesschutz",
        "unterhalt",
        "autorité parentale",
        "divorce",
        "mesures protectrices de l'union conjugale",
        "union conjugale",
    ),
    "Sachenrecht": ("sachenrecht", "dienstbarkeit", "servitude", "propriété"),
    "Obligationenrecht (allgemein)": ("obligationenrecht", "responsabilité civile"),
    "Vertragsrecht": (
        "vertrag",
        "contrat",
        "contratto",
        "arbeitsvertrag",
        "contrat de travail",
        "licenciement",
        "mietvertrag",
        "bail",
    ),
    "Raumplanung und öffentliches Baurecht": (
        "baubewilligung",
        "raumplanung",
        "permis de construire",
        "aménagement du territoire",
        "construction",
        "baugesuch",
    ),
    "Öffentliche Finanzen und Abgaberecht": ("steuer", "impôt", "tassa"),
    "Gesundheitswesen und soziale Sicherheit": (
        "gesundheitswesen",
        "santé publique",
        "soziale sicherheit",
    ),
    "Grundrecht": ("grundrecht", "droits fondamentaux", "liberté personnelle"),
    "Strassenbau und Strassenverkehr": (
        "strassenverkehr",
        "strassenbau",
        "circulation routière",
        "permis de conduire",
    ),
    "Öffentliches Dienstverhältnis": (
        "öffentliches dienstverhältnis",
        "fonction publique",
        "rapports de service",
    ),
    "Unterrichtswesen und Berufsausbildung": (
        "unterrichtswesen",
        "berufsausbildung",
        "formation professionnelle",
        "école",
    ),
    "Politische Rechte": ("politische rechte", "droits politiques", "votation"),
}

# --- fixed values: area roll-up (detailed -> intermediate, general) -------
AREA_ROLLUP = {
    "Berufliche Vorsorge": ("Sozialversicherungsrecht", "Öffentliches Recht"),
    "Invalidenversicherung": ("Sozialversicherungsrecht", "Öffentliches Recht"),
    "Unfallversicherung": ("Sozialversicherungsrecht", "Öffentliches Recht"),
    "Krankenversicherung": ("Sozialversicherungsrecht", "Öffentliches Recht"),
    "Arbeitslosenversicherung": ("Sozialversicherungsrecht", "Öffentliches Recht"),
    "Alters- und Hinterlassenenversicherung": ("Sozialversicherungsrecht", "Öffentliches Recht"),
    "Ergänzungsleistung": ("Sozialversicherungsrecht", "Öffentliches Recht"),
    "Bürgerrecht und Ausländerrecht": ("Bürgerrecht und Ausländerrecht", "Öffentliches Recht"),
    "Schuldbetreibungs- und Konkursrecht": (
        "Schuldbetreibungs- und Konkursrecht",
        "Öffentliches Recht",
    ),
    "Strafprozess": ("Strafprozess", "Strafrecht"),
    "Strafrecht (allgemein)": ("Strafrecht", "Strafrecht"),
    "Straftaten": ("Strafrecht", "Strafrecht"),
    "Familienrecht": ("Zivilrecht", "Privatrecht"),
    "Sachenrecht": ("Zivilrecht", "Privatrecht"),
    "Obligationenrecht (allgemein)": ("Obligationenrecht und Handelsrecht", "Privatrecht"),
    "Vertragsrecht": ("Obligationenrecht und Handelsrecht", "Privatrecht"),
    "Raumplanung und öffentliches Baurecht": (
        "Raumplanung und öffentliches Baurecht",
        "Öffentliches Recht",
    ),
    "Öffentliche Finanzen und Abgaberecht": (
        "Öffentliche Finanzen und Abgaberecht",
        "Öffentliches Recht",
    ),
    "Gesundheitswesen und soziale Sicherheit": (
        "Gesundheitswesen und soziale Sicherheit",
        "Öffentliches Recht",
    ),
    "Grundrecht": ("Grundrecht", "Öffentliches Recht"),
    "Strassenbau und Strassenverkehr": (
        "Strassenbau und Strassenverkehr",
        "Öffentliches Recht",
    ),
    "Öffentliches Dienstverhältnis": ("Öffentliches Dienstverhältnis", "Öffentliches Recht"),
    "Unterrichtswesen und Berufsausbildung": (
        "Unterrichtswesen und Berufsausbildung",
        "Öffentliches Recht",
    ),
    "Politische Rechte": ("Politische Rechte", "Öffentliches Recht"),
}

# --- fixed values: prompt text --------------------------------------------
PROMPT_HEADER = "Classify ambiguous fields from this judgment excerpt.\n\n"
PROMPT_LINES = (
    ("Topic", "topic"),
    ("Issue", "issue"),
    ("Parties", "parties"),
    ("Holdings", "holdings"),
    ("Text start", "text_start"),
)
REPLY_FAILED_PREFIX = "llm_failed:"

# --- fixed values: looked-at lengths (paragraphs, then characters) --------
HEAD_DOCREF = 12
HEAD_DATE = 12
HEAD_LANGUAGE = 20
HEAD_MERGED = 8
HEAD_LEADING = 15
COMPOSITION_SPAN = 11
SUBJECT_SPAN = 7
PARTY_SPAN = 15
HOLDINGS_TAIL = 18
AREA_CHARS = 3000
EVIDENCE_CHARS = 1000
CONTEXT_HOLDINGS_CHARS = 1600
CONTEXT_TEXT_CHARS = 3000
REPLY_ERROR_CHARS = 160
ERROR_MESSAGE_CHARS = 2000
DIGEST_CHARS = 16
SHARD_CHARS = 2
