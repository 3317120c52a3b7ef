"""Column -> Column functions; nothing here touches a DataFrame."""
