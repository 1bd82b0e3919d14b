"""Unifying sources into one corpus of documents and chunks.

A source is data: which column or expression makes each field of the canonical document, and which chunks it has.
All sources become one plan that Spark unions; nothing is looped over row by row.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import parse_fecha, text_only
from .chunk import explode_chunks, marked_sections, paragraphs, piece, pieces

FIELDS = ("tipo", "jerarquia", "titulo", "rubro", "clave", "epoca", "instancia", "organo", "fecha_emision", "fecha_publicacion", "status_detalle", "autor", "raw_text", "source_url")


@dataclass(frozen=True)
class SourceSpec:
    """How rows of one source become documents. ``fields`` and ``metadata`` are SQL expressions over the source's columns."""

    source: str
    native_id: str
    fields: dict[str, str]
    chunks: Callable[[], Column]
    where: str = "true"
    vigente: str = "true"
    materias: str = "array()"
    metadata: dict[str, str] = field(default_factory=dict)


def _body(kind: str, column: str, most: int | None = None) -> Column:
    return piece(kind, F.substring(column, 1, most) if most else F.col(column))


def _concat(*parts: Column) -> Column:
    return F.concat(*parts)


def _thesis_chunks() -> Column:
    own = _concat(_body("rubro", "rubro"), _body("hechos", "texto_hechos"), _body("criterio", "texto_criterios_juridicos"), _body("justificacion", "texto_justificacion"))
    return F.when(F.size(own) > 0, own).otherwise(_body("cuerpo", "texto_contenido"))


def _judgment_chunks() -> Column:
    """Title, then sections over 30 characters; the page's text only where there is nothing but the title."""
    kept = F.filter(F.coalesce("sections", F.array().cast("array<struct<type:string,text:string>>")), lambda s: F.length(s["text"]) > 30)
    kept = F.transform(kept, lambda s: F.struct(F.coalesce(F.nullif(s["type"], F.lit("")), F.lit("parrafo")).alias("type"), F.substring(s["text"], 1, 5000).alias("text")))
    title = piece("titulo", F.expr("concat(coalesce(tipo_asunto, 'None'), ' ', coalesce(num_expediente, 'None'))"))
    return _concat(title, F.when(F.size(kept) > 0, kept).otherwise(piece("cuerpo", F.substring(text_only("body_html"), 1, 8000))))


SOURCES: dict[str, SourceSpec] = {
    s.source: s
    for s in (
        SourceSpec(
            "scjn_tesis",
            "registro_digital",
            {
                "source_url": "concat('https://bj.scjn.gob.mx/documento/sentencias_pub/', registro_digital)",
                "tipo": "if(lower(coalesce(tipo, '')) like 'tesis de juris%', 'jurisprudencia', 'tesis_aislada')",
                "jerarquia": "'criterio_pjf'",
                "titulo": "coalesce(nullif(titulo, ''), rubro)",
                "rubro": "rubro",
                "clave": "clave",
                "epoca": "coalesce(nullif(epoca_nombre, ''), epoca_numero)",
                "instancia": "instancia",
                "organo": "organo_jurisdiccional",
                "fecha_publicacion": "fecha_publ_semanario",
                "status_detalle": "'vigente'",
                "raw_text": "texto_contenido",
            },
            _thesis_chunks,
            where="detail_fetched_at is not null",
            metadata={"epoca_numero": "epoca_numero", "fuente": "fuente"},
        ),
        SourceSpec(
            "scjn_historica",
            "ius",
            {"tipo": "'tesis_historica'", "jerarquia": "'criterio_pjf'", "titulo": "rubro", "rubro": "rubro", "epoca": "epoca", "instancia": "instancia", "status_detalle": "'historica'", "raw_text": "texto"},
            lambda: _concat(_body("rubro", "rubro"), _body("cuerpo", "texto")),
            metadata={"localizacion": "localizacion", "tipo": "tipo_tesis"},
        ),
        SourceSpec(
            "tfja",
            "id_tfja",
            {
                "source_url": "concat('https://www.tfja.gob.mx/cesmdfa/sctj/tesis-pdf-detalle/', id_tfja, '/')",
                "tipo": "'criterio_tfja'",
                "jerarquia": "'administrativo'",
                "titulo": "rubro",
                "rubro": "rubro",
                "clave": "clave",
                "epoca": "epoca",
                "instancia": "'TFJA'",
                "organo": "sala",
                "fecha_publicacion": "cast(anio_revista as string)",
                "status_detalle": "status",
                "autor": "ponente",
                "raw_text": "texto",
            },
            lambda: _concat(_body("rubro", "rubro"), _body("cuerpo", "texto"), _body("precedente", "precedente_raw")),
            vigente="coalesce(nullif(status, ''), 'vigente') = 'vigente'",
            materias="if(coalesce(materia, '') = '', array(), array(materia))",
            metadata={"revista_ref": "revista_ref", "precedente_raw": "precedente_raw"},
        ),
        SourceSpec(
            "sre_tratado",
            "token_sre",
            {
                "source_url": "concat('https://cja.sre.gob.mx/tratadosmexico/tratados/', token_sre)",
                "tipo": "'tratado'",
                "jerarquia": "if(tipo = 'ddhh', 'convencional', 'internacional')",
                "titulo": "nombre",
                "fecha_emision": "lugar_adopcion",
                "fecha_publicacion": "publ_dof_promulgacion",
                "status_detalle": "estatus",
                "raw_text": "coalesce(notas, '')",
            },
            lambda: _concat(_body("titulo", "nombre"), _body("notas", "notas"), _body("reserva", "reservas")),
            where="detail_fetched_at is not null",
            vigente="lower(coalesce(estatus, '')) <> 'abrogado'",
            materias="array(coalesce(nullif(tipo, ''), 'otro'))",
            metadata={c: c for c in ("categoria", "tema", "fecha_vigor_mexico", "aprobacion_senado", "tramite_constitucional", "reservas")},
        ),
        SourceSpec(
            "corte_idh",
            "concat(serie, '-', numero)",
            {"tipo": "coalesce(nullif(tipo, ''), 'sentencia_idh')", "jerarquia": "'convencional'", "titulo": "nombre", "fecha_emision": "fecha_sentencia", "raw_text": "raw_text", "source_url": "url"},
            lambda: _concat(_body("titulo", "nombre"), pieces("parrafo", paragraphs(F.col("raw_text"), most=200))),
            where="status = 'ok'",
            metadata={"pais": "pais", "anio": "cast(anio as string)", "serie": "serie"},
        ),
        SourceSpec(
            "dip_ley",
            "law_id",
            {"tipo": "'ley_federal'", "jerarquia": "'federal'", "titulo": "nombre", "fecha_publicacion": "ultima_reforma", "raw_text": "texto", "source_url": "primary_url"},
            lambda: _concat(_body("titulo", "nombre"), F.when(F.coalesce("texto", F.lit("")) != "", marked_sections(F.col("texto"), cut=4000, whole=5000)).otherwise(F.array().cast("array<struct<type:string,text:string>>"))),
            metadata={"abreviatura": "abreviatura", "categoria": "categoria"},
        ),
        SourceSpec(
            "scjn_ejecutoria",
            "registro_digital",
            {
                "source_url": "concat('https://bj.scjn.gob.mx/documento/ejecutorias/', registro_digital)",
                "tipo": "'ejecutoria'",
                "jerarquia": "'pjf_sentencia'",
                "titulo": "asunto",
                "clave": "num_expediente",
                "instancia": "organo_jurisdiccional",
                "fecha_emision": "fecha_resolucion",
                "autor": "ponente",
                "raw_text": "texto",
            },
            lambda: _concat(_body("titulo", "asunto"), pieces("parrafo", paragraphs(F.col("texto"), most=50, cap_first=True, cut=5000))),
            where="status = 'ok'",
            metadata={c: c for c in ("tipo_asunto", "votacion", "secretario")},
        ),
        SourceSpec(
            "scjn_voto",
            "registro_digital",
            {
                "source_url": "concat('https://bj.scjn.gob.mx/documento/votos/', registro_digital)",
                "tipo": "coalesce(nullif(tipo_voto, ''), 'voto_particular')",
                "jerarquia": "'pjf_sentencia'",
                "titulo": "concat('Voto — exp ', coalesce(nullif(num_expediente, ''), '?'))",
                "clave": "num_expediente",
                "instancia": "organo",
                "fecha_emision": "fecha",
                "autor": "ministro",
                "raw_text": "texto",
            },
            lambda: _body("voto", "texto", 8000),
            where="status = 'ok'",
        ),
        SourceSpec(
            "scjn_acuerdo",
            "id_native",
            {"tipo": "'acuerdo'", "jerarquia": "'pjf_acuerdo'", "titulo": "rubro", "rubro": "rubro", "instancia": "instancia", "organo": "organoJurisdiccional", "fecha_publicacion": "fechaPublicacionSemanario", "raw_text": "coalesce(rubro, '')"},
            lambda: _body("rubro", "rubro"),
            metadata={"fuente": "fuente"},
        ),
        SourceSpec(
            "scjn_vtaquigrafica",
            "id_native",
            {
                "source_url": "concat('https://bj.scjn.gob.mx/documento/vtaquigraficas/', id_native)",
                "tipo": "'version_taquigrafica'",
                "jerarquia": "'pjf_sesion'",
                "titulo": "concat('Sesión ', coalesce(fechaSesion, ''), ' — ', coalesce(organoJurisdiccional, ''))",
                "instancia": "instancia",
                "organo": "organoJurisdiccional",
                "fecha_emision": "fechaSesion",
            },
            lambda: piece("titulo", F.expr("concat('Sesión ', coalesce(fechaSesion, ''), ' — ', coalesce(organoJurisdiccional, ''))")),
            metadata={"anio": "cast(anio as string)"},
        ),
        SourceSpec(
            "scjn_voto_sentencia",
            "id_native",
            {
                "tipo": "coalesce(nullif(tipoVoto, ''), 'voto_sentencia')",
                "jerarquia": "'pjf_sentencia'",
                "titulo": "concat('Voto — exp ', coalesce(nullif(expediente, ''), '?'))",
                "clave": "expediente",
                "fecha_emision": "fechaCierreCompleto",
                "autor": "ministroFirma",
                "raw_text": "textoVoto",
            },
            lambda: _body("voto", "textoVoto", 8000),
            metadata={"asunto_id": "cast(asuntoId as string)", "tipo_asunto": "tipoAsunto"},
        ),
        SourceSpec(
            "bj_legislacion",
            "id_native",
            {
                "tipo": "if(lower(coalesce(ambito, '')) = 'federal', 'ley_federal', 'ley_estatal')",
                "jerarquia": "if(lower(coalesce(ambito, '')) = 'federal', 'federal', 'estatal')",
                "titulo": "ordenamiento",
                "fecha_publicacion": "fechaPublicado",
                "status_detalle": "vigencia",
            },
            lambda: _body("titulo", "ordenamiento"),
            vigente="lower(coalesce(vigencia, '')) in ('vigente', 'vigentes')",
            materias="if(coalesce(materia, '') = '', array(), array(materia))",
            metadata={"estado": "estado", "ambito": "ambito", "pais": "pais"},
        ),
        SourceSpec(
            "scjn_sentencia",
            "id_engrose",
            {
                "source_url": "concat('https://bj.scjn.gob.mx/documento/sentencias_pub/', id_engrose)",
                "tipo": "coalesce(nullif(tipo_asunto, ''), 'sentencia')",
                "jerarquia": "'pjf_sentencia'",
                "titulo": "concat(coalesce(tipo_asunto, 'None'), ' ', coalesce(num_expediente, 'None'))",
                "clave": "num_expediente",
                "epoca": "coalesce(nullif(epoca_nombre, ''), epoca_numero)",
                "instancia": "'SCJN'",
                "organo": "organo_radicacion",
                "fecha_emision": "fecha_resolucion",
                "autor": "ponente",
            },
            _judgment_chunks,
            metadata={"votacion": "votacion", "fuente": "fuente", "anio": "cast(anio as string)", "archivo_url": "archivo_url"},
        ),
        SourceSpec(
            "scjn_biblioteca",
            "id_native",
            {"tipo": "'publicacion_academica'", "jerarquia": "'doctrinal'", "titulo": "titulo", "autor": "autor", "raw_text": "coalesce(resumen, '')", "source_url": "urlPrimo"},
            lambda: _concat(_body("titulo", "titulo"), _body("resumen", "resumen")),
            metadata={"tema": "tema", "coleccion": "coleccion"},
        ),
        SourceSpec(
            "scjn_expediente",
            "id_native",
            {
                "tipo": "coalesce(nullif(tipoAsunto, ''), 'expediente')",
                "jerarquia": "'pjf_sentencia'",
                "titulo": "concat(coalesce(tipoAsunto, 'None'), ' ', coalesce(expediente, 'None'))",
                "clave": "expediente",
                "fecha_emision": "fechaResolucion",
            },
            lambda: _concat(piece("titulo", F.expr("concat(coalesce(tipoAsunto, 'None'), ' ', coalesce(expediente, 'None'))")), _body("tema", "tema")),
            metadata={c: c for c in ("tema", "materias", "pertenencia", "estado")},
        ),
    )
}


def with_children(parents: DataFrame, children: DataFrame, key: str, order: str, text: str, into: str = "texto", separator: str = "\n\n") -> DataFrame:
    """parents with their children's texts joined in order; parents without children have null."""
    joined = children.where(F.col(text).isNotNull() & (F.col(text) != "")).groupBy(key).agg(F.expr(f"listagg({text}, '{separator}') within group (order by {order})").alias(into))
    return parents.join(joined, key, "left")


def with_sections(parents: DataFrame, sections: DataFrame, key: str, order: str, kind: str, text: str) -> DataFrame:
    """parents with an ordered array ``sections`` of (type, text)."""
    arrays = sections.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(kind).alias("type"), F.col(text).alias("text")))).alias("s"))
    return parents.join(arrays.select(key, F.transform("s", lambda x: F.struct(x["type"].alias("type"), x["text"].alias("text"))).alias("sections")), key, "left")


def documents(df: DataFrame, spec: SourceSpec, compat: bool = False) -> DataFrame:
    """Canonical documents of one source. Dates are parsed; with ``compat`` they stay the text they were."""
    rows = df.where(spec.where)
    dates = ("fecha_emision", "fecha_publicacion")
    exprs = {f: F.expr(spec.fields.get(f, "cast(null as string)")).cast("string") for f in FIELDS}
    if not compat:
        exprs |= {d: parse_fecha(exprs[d]) for d in dates}
    meta = F.map_filter(F.create_map(*[x for k, v in spec.metadata.items() for x in (F.lit(k), F.expr(v).cast("string"))]), lambda _, v: v.isNotNull()) if spec.metadata else F.create_map().cast("map<string,string>")
    native = F.expr(spec.native_id).cast("string")
    return rows.select(
        F.xxhash64(F.lit(spec.source), native).alias("doc_id"),
        F.lit(spec.source).alias("source"),
        native.alias("source_native_id"),
        *[c.alias(f) for f, c in exprs.items()],
        F.expr(spec.vigente).alias("vigente"),
        F.expr(spec.materias).cast("array<string>").alias("materias"),
        meta.alias("metadata"),
        spec.chunks().alias("chunks"),
    )


def build_corpus(sources: dict[str, DataFrame], compat: bool = False) -> DataFrame:
    """All sources' documents in one table, each with its chunks; a source without a table is left out."""
    parts = [documents(df, SOURCES[name], compat) for name, df in sources.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def corpus_chunks(corpus: DataFrame) -> DataFrame:
    return explode_chunks(corpus, "doc_id", "chunks")
