"""Report datasets: ``DATASETS[name](tables)`` gives the DataFrame behind one chart."""

from censusmart.reports import indicators, infrastructure, staff, subjects, teachers

DATASETS = {
    **teachers.DATASETS, **indicators.DATASETS, **infrastructure.DATASETS, **staff.DATASETS,
    **subjects.DATASETS,
}
