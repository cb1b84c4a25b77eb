"""Curation of sensor time series as Spark DataFrame operators.

Conventions shared by every module:

* a table has one time column of type ``timestamp_ntz`` (naive local time), optional key columns
  naming the station, and sensor columns of type ``double``;
* a missing reading is NULL; sources turn NaN into NULL once, later steps never see NaN;
* the session time zone is UTC;
* keys are never NULL, and a ``(keys, time)`` pair is unique after the merge step.
"""

__version__ = "0.1.0"
