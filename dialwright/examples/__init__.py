"""Every operator at work on the test tables, with SQL that checks it."""
