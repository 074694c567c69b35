"""Column expressions: cleaning, dates, sectors and scores."""
