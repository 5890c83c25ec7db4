"""From hits to a pepXML document with masses, expect values, modified residues and further proteins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fixed_values import NUM_OUTPUT, VARIABLE_ADDED
from ..functions.masses import peptide_mass
from ..operators.shared import written
from ..sources.pepxml import write_pepxml
from .digest import digest
from .modifications import Modification, plain_sequence
from .search import FULL_ENDS, SPECTRUM, search
from .semi_digest import semi_digest

MOST_PROTEINS = 20  # listed with a hit; their number is exact


def marked_mass(peptide: str, modifications: list[Modification] | None = None) -> Column:
    """MH+ of a peptide as the search writes it: small m, or residues followed by the number of a modification."""
    if modifications is None:
        marks = {residue.lower(): added for residue, added in VARIABLE_ADDED.items()}
        total = peptide_mass(F.upper(peptide))
    else:
        marks = {str(k): m.added_uda for k, m in enumerate(modifications, start=1)}
        total = peptide_mass(plain_sequence(peptide))
    for mark, added in marks.items():
        times = F.length(peptide) - F.length(F.replace(F.col(peptide), F.lit(mark), F.lit("")))
        total = total + times.cast("bigint") * F.lit(added).cast("bigint")
    return total


def with_proteins(hits: DataFrame, digested: DataFrame, most: int = MOST_PROTEINS) -> DataFrame:
    """The hits with ``n_proteins``, the number of proteins that hold the peptide, and ``other_proteins``, the first of them.

    Only reported peptides are looked up, each once. A peptide of very many proteins is cut to ``most`` in each task before
    its proteins meet; the count is exact.
    """
    wanted = hits.select(plain_sequence("peptide").alias("sequence")).distinct()
    pairs = written(digested.join(wanted, "sequence", "left_semi").select("sequence", "accession").distinct(), "proteins")
    counts = pairs.groupBy("sequence").agg(F.count("*").alias("n_proteins"))
    ranked = pairs.withColumn("place", F.row_number().over(Window.partitionBy("sequence").orderBy("accession"))).where(F.col("place") <= most + 1)
    lists = ranked.groupBy("sequence").agg(F.array_sort(F.collect_list("accession")).alias("proteins"))
    found = hits.withColumn("sequence", plain_sequence("peptide")).join(counts.join(lists, "sequence"), "sequence", "left").drop("sequence")
    others = F.slice(F.filter("proteins", lambda p: p != F.col("accession")), 1, most)
    return found.withColumn("other_proteins", others).drop("proteins")


def search_to_pepxml(
    proteins: DataFrame,
    spectra: DataFrame,
    path: str,
    n: int = NUM_OUTPUT,
    most_proteins: int = MOST_PROTEINS,
    **params,
) -> DataFrame:
    """Search, and write the ``n`` best hits of each spectrum with all that pepXML holds; returns the hits as written.

    ``params`` are those of ``search``. The hits are written once to the shared folder, from which the document is made.
    """
    modifications = params.get("modifications")
    hits = written(search(proteins, spectra, n, expect=True, **params), "hits")
    digest_params = {k: params[k] for k in ("enzyme", "missed", "mass_range", "length_range") if k in params}
    termini = params.get("termini", FULL_ENDS)
    if termini == FULL_ENDS:
        digested = digest(proteins, places=False, **digest_params)
    else:
        digested = semi_digest(proteins, termini=termini, places=False, **digest_params)
    full = with_proteins(hits.withColumn("mass_uda", marked_mass("peptide", modifications)), digested, most_proteins)
    full = written(full, "reported")
    write_pepxml(full, path, n, modifications=modifications)
    return full.orderBy(*SPECTRUM, "hit_rank")
