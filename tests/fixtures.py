"""Four invented judgments and their registry rows."""

GERMAN = [
    "Bundesgericht",
    "8C_412/2011",
    "Urteil vom 14. Dezember 2011",
    "Erste sozialrechtliche Abteilung",
    "Besetzung",
    "Bundesrichterin Aebischer, Präsidentin,",
    "Bundesrichter Kübler, Zanetti,",
    "Gerichtsschreiber Loosli.",
    "Verfahrensbeteiligte",
    "Parteien",
    "Regula M., Beschwerdeführerin,",
    "gegen",
    "Gemeinde Flawil, vertreten durch Rechtsanwalt Urs Tobler, Beschwerdegegnerin.",
    "Gegenstand",
    "Unfallversicherung,",
    "Beschwerde gegen den Entscheid des Versicherungsgerichts des Kantons St. Gallen vom 2. August 2011.",
    "Sachverhalt:",
    "Der Streit betrifft eine Rente.",
    "Demnach erkennt das Bundesgericht:",
    "1.",
    "Die Beschwerde wird abgewiesen.",
]

FRENCH = [
    "Tribunal fédéral",
    "4A_87/2014",
    "Arrêt du 9 juillet 2014",
    "Première Cour de droit civil",
    "Composition",
    "Mme et MM. les Juges fédéraux Rochat, Présidente, Bovet et de Siebel.",
    "Greffier : M. Pittet.",
    "Parties",
    "Luc T., représenté par Me Anne Chappuis, avocate, recourant,",
    "contre",
    "Office des faillites de la Sarine, intimé.",
    "Objet",
    "contrat de travail (délai de congé),",
    "recours contre l'arrêt de la Cour d'appel civil du Tribunal cantonal du canton de Fribourg du 20 janvier 2014.",
    "Par ces motifs, le Tribunal fédéral prononce:",
    "1.",
    "Le recours est admis.",
]

FRENCH_SINGLE = [
    "Tribunal fédéral",
    "5D_19/2012",
    "Arrêt du 30 mars 2012",
    "Composition",
    "Mme la Juge Favrod, Présidente.",
    "Greffière : Mme Junod.",
    "Parties",
    "Inès P., recourante,",
    "contre",
    "Horlogerie du Lac SA, intimée.",
    "Objet",
    "frais judiciaires,",
    "recours contre la décision rendue le 7 février 2012 par le Tribunal cantonal du canton de Neuchâtel.",
    "Considérant que la recourante n'a pas versé l'avance de frais.",
]

ITALIAN = [
    "Tribunale federale",
    "1B.55/2009",
    "Sentenza del 18 maggio 2009",
    "Prima Corte di diritto pubblico",
    "Composizione",
    "Giudici federali Soldati, presidente,",
    "Quadri, Bianchi,",
    "cancelliere Ferrari.",
    "Parti",
    "Elio R., ricorrente, patrocinato dall'avvocato Dario Conti,",
    "contro",
    "Ministère public, resistente.",
    "Oggetto",
    "sequestro di un conto,",
    "ricorso contro la decisione emessa il 3 febbraio 2009 dal Tribunale d'appello del Cantone Ticino.",
    "Per questi motivi, il Tribunale federale pronuncia:",
    "1.",
    "Il ricorso è respinto.",
]

REGISTRY = [
    ("german", "raw/1a/german.html", "https://court.test/de", "aza://14-12-2011-8C_412-2011", "2011-12-14", "de"),
    ("french", "raw/2b/french.html", None, None, None, None),
    ("single", "raw/3c/single.html", "https://court.test/fr", "aza://30-03-2012-5D_19-2012", "2012-03-30", "fr"),
    ("italian", "raw/4d/italian.html", "https://court.test/it", "aza://18-05-2009-1B.55-2009", "2009-05-18", "it"),
]
PARAGRAPHS = {"german": GERMAN, "french": FRENCH, "single": FRENCH_SINGLE, "italian": ITALIAN}


def judgments(spark):
    rows = [
        (key, path, PARAGRAPHS[key], "\n".join(PARAGRAPHS[key]), docid, url, day, lang)
        for key, path, url, docid, day, lang in REGISTRY
    ]
    return spark.createDataFrame(
        rows,
        "html_id string, raw_html_path string, paragraphs array<string>, text string, reg_docid string, "
        "reg_url string, reg_decision_date string, reg_language string",
    )


def from_paragraphs(spark, *lists):
    rows = [(str(i), f"raw/00/{i}.html", list(p), "\n".join(p)) for i, p in enumerate(lists)]
    return spark.createDataFrame(
        rows, "html_id string, raw_html_path string, paragraphs array<string>, text string"
    )
