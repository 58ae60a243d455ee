"""Column helpers: dates, numbers as the reports print them, scalable running totals."""
