"""The jobs, end to end: admission report, session merge, graduate tables, applicant study."""
