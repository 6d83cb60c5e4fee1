"""A tiny hospital in five source folders, part parquet and part gzip CSV."""

import csv
import gzip
from pathlib import Path

import pandas as pd

from stayloom.config import FINDINGS

STAYS = 24


def _ts(day: int, hour: int = 0) -> str:
    return f"2150-{1 + day // 28:02d}-{1 + day % 28:02d} {hour:02d}:00:00"


def _parquet(folder: Path, name: str, rows: list[dict]) -> None:
    folder.mkdir(parents=True, exist_ok=True)
    pd.DataFrame(rows).to_parquet(folder / f"{name}.parquet", index=False)


def _csv(folder: Path, name: str, rows: list[dict]) -> None:
    folder.mkdir(parents=True, exist_ok=True)
    with gzip.open(folder / f"{name}.csv.gz", "wt", newline="") as out:
        writer = csv.DictWriter(out, list(rows[0]), quoting=csv.QUOTE_MINIMAL)
        writer.writeheader()
        writer.writerows(rows)


def build(root: Path) -> dict[str, str]:
    hosp, icu, cxr, jpg, note = (root / n for n in ("hosp", "icu", "cxr", "cxr_jpg", "note"))
    ids = [{"subject_id": 10000 + s // 2, "hadm_id": 20000 + s, "stay_id": 30000 + s} for s in range(STAYS)]
    adm = [{k: i[k] for k in ("subject_id", "hadm_id")} for i in ids]
    outside = {"subject_id": 99999, "hadm_id": 99999}

    _parquet(hosp, "patients", [
        {"subject_id": 10000 + p, "gender": "FM"[p % 2], "anchor_age": 40 + p, "anchor_year": 2148, "dod": None if p else _ts(3)}
        for p in range(STAYS // 2)
    ] + [{"subject_id": 99999, "gender": "F", "anchor_age": 30, "anchor_year": 2148, "dod": None}])
    _csv(hosp, "admissions", [
        {**a, "admittime": _ts(10 * s), "dischtime": _ts(10 * s + 6), "edregtime": "" if s % 2 else _ts(10 * s), "edouttime": "",
         "deathtime": _ts(10 * s + 2) if s % 5 == 0 else "", "hospital_expire_flag": int(s % 5 == 0), "admission_type": "URGENT, \"URGENT\"",
         "admission_location": "ER", "discharge_location": "HOME", "race": ["WHITE", "ASIAN - X", "OTHER"][s % 3],
         "marital_status": "" if s % 4 == 0 else "MARRIED", "language": "ENGLISH", "insurance": ["Medicare", "Other"][s % 2]}
        for s, a in enumerate(adm)
    ])
    for name in ("transfers", "drgcodes", "services", "microbiologyevents"):
        _parquet(hosp, name, [{**a, "value": s} for s, a in enumerate([*adm, outside])])
    for name, lookup in (("diagnoses_icd", "d_icd_diagnoses"), ("procedures_icd", "d_icd_procedures")):
        _csv(hosp, name, [{**a, "seq_num": 1, "icd_code": "0071", "icd_version": 9 + s % 2} for s, a in enumerate([*adm, outside])])
        _csv(hosp, lookup, [{"icd_code": "0071", "icd_version": 9, "long_title": "Title, quoted"}])
    _parquet(hosp, "labevents", [{"subject_id": a["subject_id"], "hadm_id": a["hadm_id"] if s % 2 else None, "itemid": 50000, "charttime": _ts(10 * s)} for s, a in enumerate(adm)])
    _parquet(hosp, "d_labitems", [{"itemid": 50000, "label": "Sodium", "fluid": "Blood", "category": "Chemistry"}])
    _parquet(hosp, "hcpcsevents", [{**a, "hcpcs_cd": "99"} for a in adm])
    _parquet(hosp, "d_hcpcs", [{"code": "99", "category": 1, "long_description": "x", "short_description": "y"}])
    _parquet(hosp, "emar", [{**a, "emar_id": f"e{s}", "emar_seq": 1} for s, a in enumerate(adm)])
    _parquet(hosp, "emar_detail", [{"emar_id": f"e{s}", "subject_id": 1, "emar_seq": 7, "dose_given": str(d)} for s in range(0, STAYS, 2) for d in range(3)])
    _parquet(hosp, "poe", [{**a, "poe_id": f"p{s}", "poe_seq": 1} for s, a in enumerate(adm)])
    _parquet(hosp, "poe_detail", [{"poe_id": "p1", "poe_seq": 1, "subject_id": 1, "field_name": "f", "field_value": "v"}])
    _parquet(hosp, "prescriptions", [{**a, "pharmacy_id": s, "drug": "x"} for s, a in enumerate(adm)])
    _parquet(hosp, "pharmacy", [{"pharmacy_id": s, "subject_id": 1, "hadm_id": 1, "frequency": "daily"} for s in range(5)])

    _parquet(icu, "icustays", [
        {**i, "first_careunit": "MICU", "last_careunit": "SICU", "intime": _ts(10 * s, 6), "outtime": _ts(10 * s + 1 + s % 5, 6), "los": float(1 + s % 5)}
        for s, i in enumerate(ids)
    ])
    labels = {220045: "Heart Rate", 220210: "Respiratory Rate", 223761: "Temperature Fahrenheit", 1: "Unlisted"}
    _parquet(icu, "d_items", [{"itemid": k, "label": v, "category": "Vitals", "unitname": "u"} for k, v in labels.items()])
    _parquet(icu, "chartevents", [
        {**i, "itemid": item, "charttime": _ts(10 * s + h // 24, h % 24), "storetime": _ts(10 * s + h // 24, h % 24), "valuenum": float(60 + h + s + item % 7)}
        for s, i in enumerate(ids) if s != 3 for h in range(4, 30, 2) for item in labels if (h + item + s) % 3
    ])
    for name in ("procedureevents", "outputevents", "inputevents", "datetimeevents", "ingredientevents"):
        _parquet(icu, name, [{**i, "itemid": 1, "value": s} for s, i in enumerate(ids)])

    images = [
        {"subject_id": i["subject_id"], "study_id": 500 + s, "dicom_id": f"d{s}-{k}", "day": 10 * s + k, "view": ["AP", "LATERAL"][k]}
        for s, i in enumerate(ids) if s % 2 == 0 for k in range(2)
    ]
    key = ("subject_id", "study_id", "dicom_id")
    studies = list({d["study_id"]: {k: d[k] for k in key[:2]} for d in images}.values())
    _csv(cxr, "cxr-record-list", [{**{k: d[k] for k in key}, "path": f"files/s{d['study_id']}/{d['dicom_id']}.dcm"} for d in images])
    _csv(cxr, "cxr-study-list", [{**st, "path": f"files/s{st['study_id']}.txt"} for st in studies])
    (cxr / "README.txt").write_text("not a table")
    _csv(jpg, "release-metadata", [
        {**{k: d[k] for k in key}, "StudyDate": int(_ts(d["day"])[:10].replace("-", "")), "StudyTime": 83015.5, "ViewPosition": d["view"]} for d in images
    ])
    for name in ("release-chexpert", "release-negbio"):
        _csv(jpg, name, [{**st, **{f: (i % 3) - 1.0 if i % 4 else "" for i, f in enumerate(FINDINGS)}} for st in studies])
    _csv(jpg, "release-split", [{**{k: d[k] for k in key}, "split": "train"} for d in images])

    _csv(note, "discharge", [{"note_id": f"DS{s}", **a, "charttime": _ts(10 * s + 6), "text": f"Discharged.\nDay, \"{s}\""} for s, a in enumerate(adm)])
    _csv(note, "radiology", [
        {"note_id": f"RR{s}-{k}", **a, "charttime": _ts(10 * s, 8 + k), "text": f"Chest,\nstay {s}"} for s, a in enumerate(adm) for k in range(3)
    ])
    _csv(note, "radiology_detail", [
        {"note_id": f"RR{s}-0", "subject_id": 1, "field_name": "exam", "field_value": f"v{o}", "field_ordinal": o} for s in range(0, STAYS, 2) for o in (2, 1)
    ])
    return {"hosp": str(hosp), "icu": str(icu), "cxr": str(cxr), "cxr_jpg": str(jpg), "note": str(note)}
