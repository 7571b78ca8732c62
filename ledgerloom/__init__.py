"""Operations-analytics marts over ERP tables, built on PySpark DataFrames."""
