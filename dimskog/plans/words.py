"""Words that the stand-ins for models know; queries and their SQL share them."""

# Words of the notes that a stand-in for a language model finds, with label, risk and generalization.
NOTE_WORDS = {
    "midsommar": ("temporal", "low", "en högtid"), "tonåren": ("temporal", "low", "ungdomen"), "flytten": ("social", "medium", "en händelse"),
    "semestern": ("temporal", "low", "ledigheten"), "boendet": ("social", "medium", "hemmet"), "skorstensfejare": ("demographics", "high", "hantverkare"),
}
# Words of the notes that the stand-in token model tags, by category, and those it is unsure of.
NAMED = dict.fromkeys(("Elsa", "Hassan", "Birgitta", "Torsten", "Dr", "Puls"), "Name") | dict.fromkeys(("Lomkulla", "Hägerberga", "Videboda"), "Address")
UNSURE = ("Puls",)
