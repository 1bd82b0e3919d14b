"""What the patterns, keys and classes must be for results to be the ones users expect."""

# Laws by code, as patterns over Spanish text.
LAWS = {
    "CPEUM": r"Constituci[oó]n\s+Pol[ií]tica(?:\s+de\s+los\s+Estados\s+Unidos\s+Mexicanos)?",
    "LA": r"Ley\s+de\s+Amparo",
    "LFT": r"Ley\s+Federal\s+del\s+Trabajo",
    "LFPCA": r"Ley\s+Federal\s+de\s+Procedimiento\s+Contencioso\s+Administrativo",
    "CFF": r"C[oó]digo\s+Fiscal\s+de\s+la\s+Federaci[oó]n",
    "CFPP": r"C[oó]digo\s+Federal\s+de\s+Procedimientos\s+Penales",
    "CNPP": r"C[oó]digo\s+Nacional\s+de\s+Procedimientos\s+Penales",
    "CFPC": r"C[oó]digo\s+Federal\s+de\s+Procedimientos\s+Civiles",
    "CCF": r"C[oó]digo\s+Civil\s+Federal",
    "CPF": r"C[oó]digo\s+Penal\s+Federal",
    "CComer": r"C[oó]digo\s+de\s+Comercio",
    "LISR": r"Ley\s+del\s+Impuesto\s+sobre\s+la\s+Renta",
    "LIVA": r"Ley\s+del\s+Impuesto\s+al\s+Valor\s+Agregado",
    "LGS": r"Ley\s+General\s+de\s+Salud",
    "LGEEPA": r"Ley\s+General\s+del\s+Equilibrio\s+Ecol[oó]gico",
    "LGRA": r"Ley\s+General\s+de\s+Responsabilidades\s+Administrativas",
    "LSS": r"Ley\s+del\s+Seguro\s+Social",
    "LGV": r"Ley\s+General\s+de\s+V[ií]ctimas",
    "LFTAIP": r"Ley\s+Federal\s+de\s+Transparencia",
    "LRPF": r"Ley\s+de\s+Responsabilidad\s+Patrimonial",
    "LCAMM": r"Ley\s+General\s+de\s+Acceso\s+de\s+las\s+Mujeres",
}

# Treaties by code.
TREATIES = {
    "CADH": r"Convenci[oó]n\s+Americana(?:\s+sobre\s+Derechos\s+Humanos)?|Pacto\s+de\s+San\s+Jos[eé]",
    "PIDCP": r"Pacto\s+Internacional\s+de\s+Derechos\s+Civiles\s+y\s+Pol[ií]ticos",
    "PIDESC": r"Pacto\s+Internacional\s+de\s+Derechos\s+Econ[oó]micos,?\s+Sociales\s+y\s+Culturales",
    "CDN": r"Convenci[oó]n\s+sobre\s+los\s+Derechos\s+del\s+Ni[ñn]o",
    "CAT": r"Convenci[oó]n\s+contra\s+la\s+Tortura",
    "CEDAW": r"Convenci[oó]n\s+sobre\s+la\s+Eliminaci[oó]n\s+de\s+Todas\s+las\s+Formas\s+de\s+Discriminaci[oó]n\s+contra\s+la\s+Mujer",
    "CDPD": r"Convenci[oó]n\s+sobre\s+los\s+Derechos\s+de\s+las\s+Personas\s+con\s+Discapacidad",
    "CIDFP": r"Convenci[oó]n\s+Interamericana\s+sobre\s+Desaparici[oó]n\s+Forzada",
    "Belem": r"Convenci[oó]n\s+de\s+Bel[ée]m\s+do\s+Par[aá]",
    "DUDH": r"Declaraci[oó]n\s+Universal\s+de\s+(?:los\s+)?Derechos\s+Humanos",
}

# The grammar of article references (number, fraction, paragraph) and of case keys.
ARTICLE = (
    r"(?:art[íi]culo|art\.?)\s+(\d+(?:[\s,]\d+)*(?:\s+Bis(?:\s+\d+)?)?)"
    r"(?:[,\s]+fracci[oó]n(?:es)?\s+([IVXLCDM]+(?:\s*y\s*[IVXLCDM]+)?))?"
    r"(?:[,\s]+(?:p[áa]rrafo|inciso)\s+(\w+))?"
)
CASE_KEY = (
    r"\b((?:[12]a\.?/J\.?|P\.?/J\.?|PC\.?\.?\w+\.?\s*J\.?|PR\.?\w+\.?\s*J\.?|[12]a\.?\s+CXVII)\s*\d+/\d{4}\s*\(\d{1,2}a?\.\)"
    r"|\b[IVX]+\.\w{1,3}\.\w{1,4}\.\s*\d{1,4}\s+[A-Z]\s*\(\d{1,2}a?\.\))"
)

# Class words of judgment paragraphs, in order of precedence.
SECTION_CLASSES = [
    ("datos", "encabezado"),
    ("ponente", "ponente"),
    ("resolutivo", "resolutivo"),
    ("considerando", "considerando"),
    ("antecedente", "antecedente"),
    ("precedente", "precedente"),
    ("voto", "voto"),
    ("corte", "cuerpo"),
]

# Headings of status lists, and how severe a status is.
STATUS_HEADINGS = [
    ("DEROGAD", "derogada"),
    ("SUSPEND", "suspendida"),
    (r"DEJAR\s+SIN\s+EFECTO", "sin_efectos"),
    ("MODIFICAD", "modificada"),
    ("INTERRUMP", "interrumpida"),
]
STATUS_SEVERITY = {"derogada": 5, "sin_efectos": 4, "suspendida": 3, "modificada": 2, "interrumpida": 1}
STATUS_KEY = r"\b([IVX]+\-(?:P|J|TS|TASS|TASR|TA|CASR|CASS|CASE|TJ|JL|JM|RM)\-[\w\-]+)"
#: The form whose last part is as short as it can be.
STATUS_KEY_SHORT = r"\b([IVX]+\-(?:P|J|TS|TASS|TASR|TA|CASR|CASS|CASE|TJ|JL|JM|RM)\-[\w\-]+?)\b"

# Marks in the lower-cased head of a page that give its platform away, in order.
PLATFORMS = [
    ("wp-json", "wordpress"),
    ("wp-content", "wordpress"),
    ("data-beasties-container", "angular"),
    ("_ngcontent", "angular"),
    ("asp.net", "aspnet"),
    ("viewstate", "aspnet"),
    ("drupal", "drupal"),
    ("joomla", "joomla"),
]

# Words that say what a treaty is about, in order of precedence; a first and a later list.
TREATY_KINDS = [
    ("ddhh", r"derechos\s+humanos|civiles|sociales|cultural|niño|mujer|indígena|tortura|discriminación|refugiado|asilo|protección|libertad|igualdad"),
    ("comercial", r"comerc|inversi[oó]n|aduanal|fiscal|tributari|libre\s+comercio|tlcan|t-mec|financ|econ[oó]mic|empresa|mercanc[ií]a|propiedad\s+intelectual"),
]
TREATY_KINDS_LATER = [
    ("ddhh", r"derechos\s+humanos|civiles|sociales|culturales|niñ|mujer|indígena|tortura|discriminación|refugiad|asilo|migrant|libertad|igualdad|genocidio|esclavitud|trata\s+de\s+personas|desaparición\s+forzada|defensores"),
    ("comercial", r"comerc|inversi[oó]n|aduana|fiscal|tributari|libre\s+comercio|tlcan|t-mec|financ|econ[oó]mic|empresa|mercanc[ií]a|propiedad\s+intelectual|tributo|impuesto|doble\s+(?:imposición|tributación)"),
]

# Fields of an administrative thesis, by what its text calls them.
THESIS_CLAVE = r"^Clave:\s*([^\n]+?)\s*$"
THESIS_MATERIA = r"^Materia:\s*(.+?)(?=^Clave:|\z)"
THESIS_RUBRO = r"^Rubro:\s*(.+?)(?=^[a-záéíóúñ]|^\(|^R\.T\.F|\z)"
THESIS_PRECEDENTS = r"(?:PRECEDENTE\(?S\)?|REITERACI[OÓ]N(?:\s+QUE\s+SE\s+PUBLICA)?)\s*:?\s*\n"
THESIS_PROCEDURE = r"^(?:Juicio\s+Contencioso|Revisi[oó]n\s+(?:No|N[uú]m)|Expediente\s+(?:N[uú]m|No)|Recurso\s+de\s+Apelaci[oó]n|Reclamaci[oó]n\s+(?:No|N[uú]m)|Queja\s+(?:No|N[uú]m)|Incidente\s+de\s+\w+)"
THESIS_JUICIO = (
    r"(?:Juicio\s+Contencioso\s+Administrativo|Juicio(?:\s+Atrayente)?|Revisi[oó]n|Expediente|Recurso\s+de\s+Apelaci[oó]n|Reclamaci[oó]n|Queja|Excitativa\s+de\s+Justicia|Incidente\s+de\s+\w+|Contradicci[oó]n\s+de\s+Sentencias?)"
    r"\s+(?:Atrayente\s+)?(?:N[uú]m\.?|N[uú]mero|No\.)\s*([\w\-\/\.]+)"
)
THESIS_PONENTE = r"Magistrad[oa]\s+Ponente:\s*([^\.]+?)(?=\.\-\s*Secretari|\.\s*Secretari|\-\s*Secretari|\.\s*\(|\z)"
THESIS_SECRETARIO = r"Secretari[oa](?:\s+de\s+Acuerdos)?:\s*(?:Lic\.\s*)?([^\.]+?)(?=\.\s*\(|\.\s*\z|\.\n|\(Tesis|\z)"
THESIS_VOTACION = r"((?:por\s+)?(?:unanimidad|mayor[íi]a)\s+de\s+\d+\s+votos[^\.]*?)(?=\.|\-|\z)"
THESIS_SESION = r"sesi[oó]n\s+de\s+(\d{1,2}\s+de\s+\w+\s+de\s+\d{4})"
THESIS_REVISTA = r"R\.?T\.?F\.?(?:J\.?A\.?|F\.?)[^\n]*"
THESIS_REVISTA_ANIO = r"R\.?T\.?F\.?[JF]\.?A?\.?[^\n]*?(?:A[ñn]o\s+\w+\.?\s*)?(\d{4})"

# The head of an international court's document.
COURT_CASE = r"^\s*(Caso\s+[\w\s\.,\-]+?Vs\.\s+[\w\s\.,\-]+)$"
COURT_OPINION = r"^\s*(Opinión\s+Consultiva\s+OC[-\s\d/]+[\w\s]+)$"
COURT_DATE = r"Sentencia\s+de\s+(\d{1,2}\s+de\s+\w+\s+de\s+\d{4})"

# A gazette's notes and pages.
GAZETTE_TITLE = r"<title>(?:DOF\s*-\s*)?([^<]+)</title>"
GAZETTE_ISSUER = r"<b>SECRETAR[ÍI]A\s+DE\s+([^<\n]{3,80})</b>"
GAZETTE_KIND = r"^(DECRETO\s+(?:PROMULGATORIO|POR\s+EL\s+QUE)?[^.\n]{0,80}|ACUERDO[^.\n]{0,80}|REGLAMENTO[^.\n]{0,80}|LEY[^.\n]{0,80}|RESOLUCI[ÓO]N[^.\n]{0,80}|AVISO[^.\n]{0,80}|CIRCULAR[^.\n]{0,80})"
GAZETTE_SELECTORS = ("#DivDetalleNota", "#detalleNota", "div.detalleNota", "article", "main", "div.content", "div#content")
GAZETTE_DROPPED = ("script", "style", "noscript", "iframe", "form")
GAZETTE_CHROME = r"(DOF\s*-\s*Diario Oficial de la Federación|jkmegamenu\.definemenu|\$\(document\)\.ready|var nombre_cookie|function getCookie|ARRcookies|setCookie|document\.cookie|window\.|<\?-?-|var\s+\w+\s*=)"
GAZETTE_BEGINNING = r"(SECRETARÍA DE|PODER (?:EJECUTIVO|JUDICIAL)|DECRETO|ACUERDO|RESOLUCIÓN|AVISO|CONVENIO|REGLAMENTO|MANUAL|PROGRAMA|ANTEPROYECTO|FE\s+DE\s+ERRATAS)\b"

# An electoral court's thesis pages.
ELECTORAL_RUBRO = r"(?:rubro|sumario)[\s:]+([A-ZÁÉÍÓÚÑ][^<\n]{15,300})"
ELECTORAL_CLAVE = r"\b((?:Jurisprudencia|Tesis)\s+(?:[XLI]+/?)?\d{1,4}\s*/\s*\d{4})"
ELECTORAL_INSTANCIA = r"\b(Sala\s+Superior|Sala\s+Regional[^\n<]*)\b"
ELECTORAL_TIPO = r"\b(Jurisprudencia|Tesis\s+Aislada|Tesis\s+(?:Relevante|Vinculante))\b"
ELECTORAL_PARTES = r"(?:Actor|Promovente|Demandante)[\s:]+([^\n<]{3,200})"
ELECTORAL_FECHA = r"(\d{1,2}\s+de\s+\w+\s+de\s+(\d{4}))"

# Forms of a recommendation's number and year, in a link's label and in its address; fields of its text.
RECOMMENDATION_LABELS = (r"Rec(?:omendaci[oó]n)?[\s/\-#]*(\d{1,4})\s*/\s*(\d{4})", r"(\d{1,4})\s*/\s*(\d{4})")
RECOMMENDATION_ADDRESSES = (r"Rec(\d{1,4})_?(\d{4})", r"/(\d{4})-(\d{1,4})/", r"Rec(\d+)_(\d+)")
RECOMMENDATION_NUMBER = r"Recomendaci[oó]n\s+(?:No\.|N[uú]mero)?\s*(\d+/\d{4}|\d+[\sde]+\d{4})"
RECOMMENDATION_ADDRESSEE = r"(?:DESTINATARIA|DESTINATARIO|destinada\s+a|dirigida\s+a)[:\s]+([^\n\r\.;]+)"
RECOMMENDATION_DATE = r"M[eé]xico,\s+(?:Ciudad\s+de\s+M[eé]xico,\s+)?(?:a\s+)?(\d{1,2}\s+de\s+\w+\s+de\s+\d{4})"
RECOMMENDATION_SUBJECT = r"^\s*(?:Tema|Caso)[:\s]+(.{20,300})"

# Words that a state law's title begins with.
LAW_WORDS = "LEY|CÓDIGO|REGLAMENTO|DECRETO|ESTATUTO|MANUAL|ACUERDO|REGLAS|LINEAMIENTOS|ARANCEL"

# Treaty names (folded) and their registry numbers, in order of precedence.
TREATY_REGISTRY = [
    ("pacto internacional de derechos civiles y politicos", "IV-4"),
    ("pacto internacional de derechos economicos sociales y culturales", "IV-3"),
    ("convencion contra la tortura", "IV-9"),
    ("convencion sobre los derechos del nino", "IV-11"),
    ("convencion sobre la eliminacion de todas las formas de discriminacion contra la mujer", "IV-8"),
    ("convencion internacional sobre la eliminacion de todas las formas de discriminacion racial", "IV-2"),
    ("convencion sobre los derechos de las personas con discapacidad", "IV-15"),
    ("convencion para la prevencion y la sancion del delito de genocidio", "IV-1"),
    ("convencion internacional para la proteccion de todas las personas contra las desapariciones forzadas", "IV-16"),
    ("convencion internacional sobre la proteccion de los derechos de todos los trabajadores migratorios", "IV-13"),
    ("protocolo facultativo del pacto internacional de derechos civiles", "IV-5"),
    ("segundo protocolo facultativo del pacto internacional", "IV-12"),
    ("protocolo facultativo de la convencion sobre los derechos del nino relativo a la venta", "IV-11-c"),
    ("protocolo facultativo de la convencion sobre los derechos del nino relativo a la participacion", "IV-11-b"),
    ("protocolo facultativo de la convencion contra la tortura", "IV-9-b"),
    ("convencion sobre la imprescriptibilidad de los crimenes de guerra", "IV-6"),
    ("convencion sobre el estatuto de los refugiados", "V-2"),
    ("convencion sobre el estatuto de los apatridas", "V-3"),
    ("convencion para reducir los casos de apatridia", "V-4"),
    ("convencion sobre los derechos politicos de la mujer", "XVI-1"),
    ("convencion sobre la nacionalidad de la mujer casada", "XVI-2"),
    ("convencion sobre el consentimiento para el matrimonio", "XVI-3"),
    ("convencion unica de 1961 sobre estupefacientes", "VI-15"),
    ("convencion de las naciones unidas contra la delincuencia organizada", "XVIII-12"),
    ("protocolo para prevenir, reprimir y sancionar la trata", "XVIII-12-a"),
    ("convencion de las naciones unidas contra la corrupcion", "XVIII-14"),
    ("convencion contra el trafico ilicito de estupefacientes", "VI-19"),
    ("convencion de viena sobre relaciones diplomaticas", "III-3"),
    ("convencion de viena sobre relaciones consulares", "III-6"),
    ("convencion de viena sobre el derecho de los tratados", "XXIII-1"),
    ("convencion de las naciones unidas sobre el derecho del mar", "XXI-6"),
    ("convencion marco de las naciones unidas sobre el cambio climatico", "XXVII-7"),
    ("protocolo de kyoto", "XXVII-7-a"),
    ("acuerdo de paris", "XXVII-7-d"),
    ("convenio sobre la diversidad biologica", "XXVII-8"),
    ("protocolo de nagoya", "XXVII-8-b"),
    ("convencion de basilea", "XXVII-3"),
    ("protocolo de montreal", "XXVII-2-a"),
]
