"""Sentences to draw words from."""

PROSE = {
    "en": "the cat sat on the mat and then it went home with the other cats of this town because it was late",
    "de": "der hund lief durch den wald und dann ging er nach hause weil es schon spät war und er müde wurde",
    "fr": "le chat est sur la table et puis il est parti à la maison avec les autres chats de cette ville",
    "es": "el perro corrió por el bosque y luego se fue a casa porque ya era tarde y estaba muy cansado hoy",
}
