"""Column expressions and small composed operators shared by the steps."""
