"""Fixed values of the data contract: names, formats, patterns and limits."""

from __future__ import annotations

STATUSES = ("assinado", "sem_assinatura", "indeterminado", "erro", "nao_suportado", "container")

PDF = (".pdf",)
IMAGES = (".jpg", ".jpeg", ".jfif", ".png", ".tif", ".tiff", ".bmp", ".gif", ".webp", ".pnm", ".pgm")
OOXML = (".docx", ".docm", ".pptx", ".pptm")
ZIP = (".zip",)
#: Where a package keeps its text parts and its pictures.
OOXML_TEXT = {".docx": "word/document.xml", ".docm": "word/document.xml", ".pptx": "ppt/slides/slide", ".pptm": "ppt/slides/slide"}
OOXML_MEDIA = {".docx": "word/media/", ".docm": "word/media/", ".pptx": "ppt/media/", ".pptm": "ppt/media/"}

MAX_XML_BYTES = 64 * 1024 * 1024
MAX_MEDIA_BYTES = 256 * 1024 * 1024
MAX_MEDIA_FILES = 200
MAX_ZIP_BYTES = 8 * 1024**3
MAX_ZIP_FILES = 20_000
MAX_ZIP_DEPTH = 3
#: A member of an archive has to fit a binary value.
MAX_MEMBER_BYTES = 1 << 30
MIN_MEDIA_WIDTH, MIN_MEDIA_HEIGHT = 64, 32

DARK_PIXEL = 200
MIN_INK = 0.0005
MIN_PKCS7_BYTES = 64
ID_LENGTH = 12
MAX_DOUBT = 0.05
Z95 = 1.959964

#: Risk strata in report order.
STRATA = (
    "neg_paginas_limitadas",
    "neg_sem_pagina_analisada",
    "neg_ooxml",
    "neg_imagem",
    "neg_pdf_1pag",
    "neg_pdf_2pag",
    "neg_pdf_3pag_ou_mais",
    "pos_resgatado_fallback",
    "pos_nivel1_uma_deteccao",
    "pos_nivel1_varias",
    "pos_nivel0",
)
FORM_GROUPS = ("so_acroform", "com_outra_evidencia")
FORM_VERDICTS = ("assinado", "campo_vazio", "incompleto", "sem_campo", "erro")
CARD_ORDER = ("fn", "fp", "duvida", "vp", "vn")
REVIEW_CAUSES = ("rever", "rotulagem")
LABEL_WORDS = {"sim": True, "nao": False, "duvida": None}
LABEL_FOLDERS = {"com_assinatura": True, "sem_assinatura": False, "duvida": None}

#: Marks of a digital signature stamp, in the order in which they count.
STAMP_MARKS = (
    r"assinad[oa]\s+digitalmente",
    r"assinad[oa]\s+eletronicamente",
    r"assinatura\s+digital",
    r"assinatura\s+eletr[oô]nica",
    r"icp[-\s]?brasil",
    r"certificad[oa]\s+digital",
    r"documento\s+assinado\s+(?:digital|eletronic)",
    r"\bDN:\s*C=",
)
STAMP_SIGNER = r"assinad[oa]\s+(?:digitalmente|eletronicamente)?\s*por[:\s]+([^\n\r]+)"
#: Labels of a place where a signature is expected.
SIGNATURE_LABELS = (
    r"assinatura\s+d[oae]s?\s+\w+",
    r"assinatura[:\s]*_{3,}",
    r"_{5,}\s*\n?\s*assinatura",
    r"\bvisto\s+d[oae]\b",
    r"ciente\s+e\s+de\s+acordo",
    r"recebi\s+(?:o|a|as|os)\s+\w+",
)
CERTIFICATE_NAME = r"[A-Z][A-Z]+(?:[ ][A-Z][A-Z]*){1,6}"
XML_BREAK = r"</[wa]:p>|<[wa]:br\s*/>|<w:cr\s*/>"
XML_TAB = r"<w:tab\s*/>"
XML_TAG = r"<[^>]+>"
