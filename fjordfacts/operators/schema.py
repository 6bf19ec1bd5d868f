"""The 34 canonical fields as a dimension, and the schemas of the engine's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORDS = "doc_id bigint, page_no int, block_id int, par_id int, line_id int, word_id int, left int, top int, width int, height int, conf double, text string"
SPEC = "ord int, canonical string, api_path string, layout string, labels array<string>, tolerance string, optional boolean"

# Canonical name; path in the registry record; labels, the first one first; tolerance.
_META = """
orgnr; virksomhet.organisasjonsnummer; Organisasjonsnummer; exact
foretaksnavn; virksomhet.navn; Foretaksnavn; str_match
organisasjonsform; virksomhet.organisasjonsform; Organisasjonsform; str_match
regnskapstype; regnskapstype; Regnskapstype; str_match
regnskapsperiode_fra; regnskapsperiode.fraDato; Årsregnskapets periode; str_match
regnskapsperiode_til; regnskapsperiode.tilDato; Årsregnskapets periode; str_match
valuta; valuta; Beløp i, Valuta; str_match
oppstillingsplan; oppstillingsplan; Oppstillingsplan; str_match
smaa_foretak; regnkapsprinsipper.smaaForetak; Regler for små foretak benyttet; bool_match
morselskap; virksomhet.morselskap; Morselskap i konsern; bool_match
avviklingsregnskap; avviklingsregnskap; Avviklingsregnskap; bool_match
ikke_revidert; revisjon.ikkeRevidertAarsregnskap; Ikke revidert; bool_match
fravalg_revisjon; revisjon.fravalgRevisjon; Fravalg av revisjon; bool_match
regnskapsregler; regnkapsprinsipper.regnskapsregler; Regnskapsregler; str_match
journalnr; journalnr; Journalnummer; exact"""
_RESULTAT = """
sum_driftsinntekter; resultatregnskapResultat.driftsresultat.driftsinntekter.sumDriftsinntekter; Sum driftsinntekter, Sum inntekter; pct1
sum_driftskostnad; resultatregnskapResultat.driftsresultat.driftskostnad.sumDriftskostnad; Sum driftskostnader, Sum driftskostnad, Sum kostnader; pct1
driftsresultat; resultatregnskapResultat.driftsresultat.driftsresultat; Driftsresultat; pct1
sum_finansinntekter; resultatregnskapResultat.finansresultat.finansinntekt.sumFinansinntekter; Sum finansinntekter; pct1
sum_finanskostnad; resultatregnskapResultat.finansresultat.finanskostnad.sumFinanskostnad; Sum finanskostnader; pct1
netto_finans; resultatregnskapResultat.finansresultat.nettoFinans; Netto finansposter, Sum netto finansposter, Resultat av finansposter, Netto finans; pct1
ordinaert_resultat_for_skatt; resultatregnskapResultat.ordinaertResultatFoerSkattekostnad; Ordinært resultat før skattekostnad, Resultat før skattekostnad, Ordinært resultat før skatt, Resultat før skatt; pct1
aarsresultat; resultatregnskapResultat.aarsresultat; Årsresultat; pct1
totalresultat; resultatregnskapResultat.totalresultat; Totalresultat; pct1; optional"""
_BALANSE = """
sum_anleggsmidler; eiendeler.anleggsmidler.sumAnleggsmidler; Sum anleggsmidler; pct1
sum_omloepsmidler; eiendeler.omloepsmidler.sumOmloepsmidler; Sum omløpsmidler, Sum omloepsmidler; pct1
sum_eiendeler; eiendeler.sumEiendeler; Sum eiendeler, SUM EIENDELER; pct1
sum_innskutt_egenkapital; egenkapitalGjeld.egenkapital.innskuttEgenkapital.sumInnskuttEgenkaptial; Sum innskutt egenkapital; pct1
sum_opptjent_egenkapital; egenkapitalGjeld.egenkapital.opptjentEgenkapital.sumOpptjentEgenkapital; Sum opptjent egenkapital; pct1
sum_egenkapital; egenkapitalGjeld.egenkapital.sumEgenkapital; Sum egenkapital; pct1
sum_langsiktig_gjeld; egenkapitalGjeld.gjeldOversikt.langsiktigGjeld.sumLangsiktigGjeld; Sum langsiktig gjeld; pct1; optional
sum_kortsiktig_gjeld; egenkapitalGjeld.gjeldOversikt.kortsiktigGjeld.sumKortsiktigGjeld; Sum kortsiktig gjeld; pct1; optional
sum_gjeld; egenkapitalGjeld.gjeldOversikt.sumGjeld; Sum gjeld; pct1
sum_egenkapital_gjeld; egenkapitalGjeld.sumEgenkapitalGjeld; Sum egenkapital og gjeld, SUM EGENKAPITAL OG GJELD, Sum gjeld og egenkapital; pct1"""


def _rows() -> list[tuple]:
    out = []
    for layout, block in (("generell", _META), ("resultat", _RESULTAT), ("balanse", _BALANSE)):
        for line in block.strip().splitlines():
            name, path, labels, tolerance, *rest = [x.strip() for x in line.split(";")]
            out.append((len(out), name, path, layout, [x.strip() for x in labels.split(",")], tolerance, bool(rest)))
    return out


FIELDS = _rows()


def field_spec(spark: SparkSession) -> DataFrame:
    """34 rows: always small enough to broadcast."""
    return spark.createDataFrame(FIELDS, SPEC)


def by_layout(spec: DataFrame, layout: str) -> DataFrame:
    return spec.where(F.col("layout") == layout)


def field(spec: DataFrame, canonical: str) -> DataFrame:
    return spec.where(F.col("canonical") == canonical)


def scan_labels(spark: SparkSession) -> DataFrame:
    """(canonical, label_ord, label) of the statement fields."""
    return field_spec(spark).where("layout <> 'generell'").select("canonical", F.posexplode("labels").alias("label_ord", "label"))
