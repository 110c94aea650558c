"""Column functions: no function here touches rows or runs Python on executors."""
