"""Complete reports. ``REPORTS`` holds them by key."""

from eavista import values
from eavista.plans import (
    diagnoses, drugs, history, note, prescriptions, registration, visits, vitals,
)
from eavista.plans.report import Report

REPORTS = {
    report.key: report
    for report in (
        Report("meds_stock", {"meds": drugs.meds_stock}),
        Report("meds_dispensed", {"meds": drugs.meds_dispensed}),
        Report("visits", {"visits": visits.visits}),
        Report("visit_diagnoses", {"diagnoses": visits.visit_diagnoses}),
        Report("epidemiology", {"diagnoses": visits.epidemiology}),
        Report("diagnoses", {"diagnoses": diagnoses.diagnoses}),
        Report("vitals", {"vitals": vitals.vitals}),
        Report("front_sheet", {"patients": registration.front_sheet}, by_patient=True),
        Report("clinical_history", {"histories": history.history}, by_patient=True),
        Report("clinical_note", {"consults": note.clinical_note}, designs=values.NOTE_DESIGNS),
        Report(
            "controlled_prescriptions",
            {
                "encounters": prescriptions.controlled_encounters,
                "prescriptions": prescriptions.controlled_meds,
            },
            by_patient=True,
        ),
    )
}
