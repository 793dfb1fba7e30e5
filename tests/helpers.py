"""Small fact frames and row comparison."""

from cohortweave.schema import FACTS, SUBJECTS

FIELDS = FACTS.fieldNames()


def facts(spark, *rows):
    """Facts from dicts; ids are numbered when absent."""
    from decimal import Decimal

    out = []
    for i, row in enumerate(rows, start=1):
        full = {"fact_id": i, "source_study": "STUDY_A", **row}
        if full.get("visitnum") is not None:
            full["visitnum"] = Decimal(full["visitnum"])
        out.append(tuple(full.get(f) for f in FIELDS))
    return spark.createDataFrame(out, FACTS)


def event(domain, subject, seq, visit=None, study="STUDY_A", **values):
    """Facts of one event, one per variable."""
    return [dict(domain=domain, subject_key=subject, seqnum=seq, visitnum=visit, source_study=study,
                 standard_var=var, standard_label=var, value=value) for var, value in values.items()]


def subjects(spark, *rows):
    names = SUBJECTS.fieldNames()
    return spark.createDataFrame(
        [tuple({"source_study": "STUDY_A", **row}.get(n) for n in names) for row in rows], SUBJECTS)


class AnyOrder(list):
    """Rows that equal any list of the same rows."""

    def __eq__(self, other):
        return sorted(self, key=repr) == sorted(other, key=repr)


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return AnyOrder(tuple(r) for r in picked.collect())
