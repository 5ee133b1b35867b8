"""Parameters of the registered queries, shared with their SQL."""

START_DATE = "1996-01-01"
AS_OF = "2001-09-30"
NOW = "2001-08-02 18:30:00"
CUT = "2000-01-01"
CUT_TIME = "2000-01-01 00:00:00"
EARLY_CUT_TIME = "1999-01-01 00:00:00"
