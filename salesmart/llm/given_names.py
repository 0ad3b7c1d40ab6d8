"""Given names by script and gender that person names are detected by ('' : used by both).

Fixed values: frequent given names of English, Spanish, Portuguese, French,
German, Dutch, Italian, Polish, Czech, Scandinavian, Turkish, Arabic, Indian
and East Asian (Latin spelling), Russian, Ukrainian, Bulgarian and Greek use.
Names that are mostly other words at the start of a sentence, months or places
(Will, Hope, May, April, Virginia, Georgia, Austin, Jordan, Christian) are not in it.
"""

KNOWN = {
    ("latin", "f"): """
        Abigail Ada Adele Adriana Agata Agnes Agnieszka Aicha Aisha Alana Alba Alejandra Aleksandra Alessandra Alessia Alexandra Alexis Alice Alicia
        Alina Aline Alison Allison Alma Alyssa Amalia Amanda Amelia Amelie Amina Amy Ana Anastasia Andrea Angela Angelica Angelina Anika Anita
        Anja Anke Ann Anna Anne Anneke Annette Annie Antonella Antonia Aparna Ariana Arlene Ashley Asma Astrid Aurora Ava Ayesha Ayse Barbara Beata
        Beatrice Beatriz Becky Bernadette Bernice Beth Bethany Betty Beverly Bianca Birgit Birgitta Bonnie Brenda Brianna Bridget Brigitte Britta
        Brittany Brooke Camila Camilla Camille Candice Carina Carla Carmen Carol Caroline Carolyn Carrie Catalina Caterina Catherine Cathy Cecilia
        Celeste Celia Celine Chantal Charlene Charlotte Chiara Chloe Christa Christiane Christina Christine Cindy Claire Clara Claudia Colette
        Colleen Connie Constance Cristina Cynthia Dagmar Daisy Daniela Danielle Daphne Debbie Deborah Debra Deepa Delia Denise Diana Diane Dolores
        Dominique Donna Dora Doris Dorothy Edith Edna Eileen Elaine Eleanor Elena Eleonora Elif Elisa Elisabeth Elise Eliza Elizabeth Elke Ella Ellen
        Eloise Elsa Elsie Elvira Emilia Emily Emine Emma Erica Erika Erin Esmeralda Esperanza Estelle Esther Ethel Eugenia Eunice Eva Eve Evelyn
        Fatima Fatma Federica Fernanda Fiona Flora Florencia Frances Francesca Francine Francisca Franziska Freya Frida Gabriela Gabriella Gabrielle
        Gail Gemma Genevieve Geraldine Gertrude Gianna Gina Giorgia Gisela Giulia Gladys Gloria Grace Graciela Greta Gretchen Guadalupe Gwen
        Gwendolyn Hanna Hannah Hannelore Harriet Hatice Hazel Heather Heidi Heike Helen Helena Helene Helga Henrietta Hilda Hilary Hildegard Ida Ilse
        Imani Ines Inga Inge Ingrid Irene Irina Iris Irma Isabel Isabella Isabelle Ivana Ivy Jacqueline Jana Jane Janet Janice Janine Jasmin Jasmine
        Jean Jeanette Jeanne Jennifer Jenny Jessica Jill Jimena Joan Joana Joann Joanna Joanne Jocelyn Johanna Josefina Josephine Joyce Juana Juanita
        Judith Judy Julia Juliana Julie Juliet Juliette Jutta Kaitlyn Karen Karin Karina Karla Karolina Katarina Katarzyna Kate Katharina
        Katherine Kathleen Kathryn Kathy Katie Katrin Katrina Kavita Kayla Kelsey Kerstin Khadija Kimberly Kirsten Klara Kristen Kristin Kristina
        Kristine Krystyna Lakshmi Lara Larissa Laura Lauren Laurie Layla Lea Leah Leila Lena Leonor Leonora Leticia Leyla Lidia Lillian Lily Lina
        Linda Lisa Lise Liv Livia Liza Lois Lola Loretta Lorena Lorraine Louise Lourdes Lucia Lucie Lucille Lucinda Lucy Ludmila Luisa Luise Luz Lydia
        Lynn Mabel Madeleine Madeline Magda Magdalena Maja Malgorzata Mandy Manon Manuela Marcela Marcia Margaret Margarita Margot Marguerite Maria
        Mariam Marian Mariana Marianne Marie Marilyn Marina Marion Marisa Marisol Marjorie Marlene Marta Martha Martina Mary Maryam Mathilde Matilda
        Maureen Maya Megan Mei Meera Melanie Melinda Melissa Meredith Mia Michaela Michele Michelle Mildred Mina Miranda Miriam Moira Molly
        Monica Monika Monique Muriel Myra Myrtle Nadia Nadine Nancy Naomi Natalia Natalie Natasha Neha Nicole Nina Noemi Noor Nora Norma Odette Olga
        Olivia Ophelia Oriana Paloma Pamela Patricia Patrizia Paula Paulina Pauline Peggy Penelope Petra Phoebe Phyllis Pilar Pooja Priscilla
        Priya Rachel Ramona Raquel Rebecca Regina Renata Renate Renee Rhonda Rita Roberta Rocio Rosa Rosalie Rosalind Rosario Rose Rosemary Roxana
        Roxanne Ruth Sabina Sabine Sabrina Sally Samantha Sandra Sanne Sara Sarah Saskia Selena Selma Shannon Sharon Sheila Shelley Sherry Shirley
        Sigrid Silke Silvia Simona Simone Sofia Sofie Sonia Sonja Sophia Sophie Stacey Stefania Stefanie Stella Stephanie Sue Sunita Susan Susana
        Susanne Suzanne Svetlana Sybil Sylvia Sylvie Tamara Tammy Tania Tanja Tanya Tara Tatiana Teresa Teresita Thelma Theodora Theresa Therese
        Tiffany Tina Tracy Trudy Ursula Ute Valentina Valeria Valerie Vanessa Vera Verena Veronica Veronika Vicky Victoria Viktoria Viola Violet
        Viviana Vivian Wanda Wendy Wilhelmina Wilma Winifred Xenia Yasmin Yolanda Yuki Yvette Yvonne Zainab Zeynep Zoe Zofia Zuzana
        """.split(),
    ("latin", "m"): """
        Aaron Abdul Abdullah Abel Abraham Achim Adam Adolfo Adrian Ahmad Ahmed Akira Alain Alan Albert Alberto Albrecht Alejandro Aleksander Alessandro
        Alex Alexander Alexandre Alexis Alfonso Alfred Alfredo Ali Allan Allen Alvaro Alvin Amir Amit Anand Anders Andre Andreas Andres Andrew Andrzej
        Andy Angelo Anil Anthony Anton Antonio Antoine Armando Arjun Arne Arnold Arthur Arturo Arun Ashok Augusto Axel Barry Bartosz Bashir
        Bastian Ben Benedict Benito Benjamin Benoit Bernard Bernardo Bernd Bernhard Bill Billy Bjorn Bob Bobby Boris Brad Bradley Brandon Brent Brett
        Brian Bruce Bruno Bryan Bryce Byron Caleb Calvin Cameron Carl Carlo Carlos Carsten Cedric Cesar Charles Charlie Christoph Christophe
        Christopher Clarence Claude Claudio Claus Clifford Clive Clyde Cody Colin Connor Conrad Corey Craig Cristian Curtis Cyril Dale Damian Damien
        Dan Daniel Daniele Danny Dario Darrell Darren Daryl Dave David Davide Dean Deepak Denis Dennis Derek Dermot Diego Dieter Dietmar Dietrich Dirk
        Dmitri Dominic Dominik Don Donald Douglas Duncan Dustin Dwayne Dylan Eberhard Eddie Edgar Edmund Eduardo Edward Edwin Egon Elias Elijah
        Elliot Elmer Emanuel Emil Emiliano Emilio Emmanuel Enrico Enrique Eric Erich Erik Ernest Ernesto Ernst Ethan Etienne Eugen Eugene Evan Ezra
        Fabian Fabio Fabrice Farid Federico Felipe Felix Ferdinand Fernando Filip Filippo Finn Floyd Francesco Francis Francisco Franck Franco Francois
        Frank Franz Fred Frederic Frederick Friedrich Fritz Gabriel Gareth Gary Gaston Gavin Gene Geoffrey George Georg Georges Gerald Gerard Gerardo
        Gerhard Gert Gilbert Gilberto Giacomo Gianluca Giorgio Giovanni Giuseppe Glen Glenn Gonzalo Gordon Graham Greg Gregor Gregory Grzegorz Guido
        Guillaume Guillermo Gunnar Gunther Gustav Gustavo Guy Hamza Hans Harald Harold Harry Harvey Hasan Hassan Hector Heiko Heiner Heinrich Heinz
        Helmut Hendrik Henri Henrik Henry Herbert Herman Hermann Hiroshi Holger Horst Howard Hubert Hugh Hugo Humberto Hussein Ian Ibrahim Ignacio
        Igor Ingo Isaac Isaiah Ismael Ivan Jack Jacek Jacob Jacques Jaime Jake Jakob Jakub James Jamal Jan Janusz Jared Jason Javier Jay Jean
        Jeff Jeffrey Jens Jeremiah Jeremy Jerome Jerry Jerzy Jim Jimmy Joachim Joao Joaquin Jochen Joe Joel Joerg Johan Johann Johannes John Johnny Jon
        Jonas Jonathan Jorge Jose Josef Joseph Josh Joshua Josip Juan Juergen Jules Julian Julien Julio Julius Junaid Justin Kai Karim Karl Karsten
        Kaspar Keith Ken Kenji Kenneth Kevin Khalid Kirk Klaus Knut Konrad Konstantin Krzysztof Kurt Kyle Lamar Lars Laszlo Laurent Lawrence Leo
        Leon Leonard Leonardo Leopold Leroy Lewis Liam Lionel Lloyd Lorenzo Lothar Louis Luca Lucas Luciano Ludwig Luigi Luis Luiz Lukas Luke Lutz
        Maciej Magnus Mahmoud Malcolm Manfred Manuel Marc Marcel Marcello Marcin Marco Marcos Marcus Marek Mario Marius Mark Marko Markus Martin Marvin
        Massimo Mateo Mateusz Mathias Matteo Matthew Matthias Matthieu Maurice Mauricio Mauro Max Maxime Maximilian Maxwell Mehmet Melvin Michael
        Michal Michel Miguel Mike Mikhail Milton Mitchell Mohamed Mohammad Mohammed Morris Moritz Muhammad Murat Mustafa Nathan Nathaniel Neil
        Nelson Niall Nicholas Nick Nicola Nicolas Niels Nigel Nikhil Niklas Nikolai Nils Noah Noel Norbert Norman Oleg Oliver Olivier Omar
        Oscar Oskar Osvaldo Otto Owen Pablo Paolo Pascal Patricio Patrick Patrik Paul Paulo Pavel Pawel Pedro Percy Peter Phil Philip Philipp
        Philippe Phillip Pierre Piero Pietro Piotr Rafael Rahul Rainer Raj Rajesh Ralf Ralph Ramon Randall Randy Rashid Raul Ravi Ray Raymond Reginald
        Reiner Reinhard Renato Ricardo Riccardo Richard Rick Ricky Robert Roberto Rodney Rodolfo Rodrigo Roger Rohan Roland Rolf Roman Romeo Ron Ronald
        Ronnie Rory Ross Roy Ruben Rudolf Rudy Russell Ryan Sachin Salvador Salvatore Sam Samir Samuel Sandro Sanjay Santiago Scott Sean
        Sebastian Sebastien Serge Sergei Sergio Seth Shane Shaun Shawn Sidney Siegfried Silvio Simon Slawomir Solomon Soren Stanislav Stanislaw Stanley
        Stefan Stefano Stephan Stephane Stephen Steve Steven Stewart Stuart Suresh Sven Taro Ted Terence Terrence Thabo Theo Theodor Theodore Thierry
        Thomas Thorsten Tibor Tim Timo Timothy Tobias Todd Tom Tomas Tomasz Tommy Toni Tony Torsten Travis Trevor Troy Tyler Udo Ulf Ulrich Umberto Uwe
        Vaclav Valentin Valentino Vernon Victor Vijay Viktor Vikram Vince Vincent Vincenzo Vinod Vladimir Volker Walter Wayne Werner Wesley Wilfred
        Wilhelm William Willie Wojciech Wolfgang Xavier Yann Yannick Youssef Yusuf Yves Zachary Zbigniew Zoltan
        """.split(),
    ("latin", ""): "Ariel Casey Chris Dana Jamie Jesse Jo Kelly Kerry Kim Kris Leslie Morgan Riley Robin Sasha Stacy Taylor Terry Toby".split(),
    ("cyrillic", "f"): """
        Александра Алина Алла Алёна Анастасия Ангелина Анна Валентина Валерия Вера Вероника Виктория Галина Дарья Диана Евгения Екатерина Елена
        Елизавета Жанна Зинаида Зоя Инна Ирина Камилла Карина Кира Ксения Лариса Лидия Любовь Людмила Маргарита Марина Мария Надежда Наталия Наталья
        Нина Оксана Ольга Полина Раиса Светлана София Софья Тамара Татьяна Ульяна Юлия Яна Ирена Десислава Мариана Олена Тетяна Наталія Юлія Марія
        """.split(),
    ("cyrillic", "m"): """
        Александр Алексей Анатолий Андрей Антон Аркадий Артур Артём Богдан Борис Вадим Валентин Валерий Василий Виктор Виталий Владимир Владислав
        Вячеслав Геннадий Георгий Глеб Григорий Даниил Денис Дмитрий Евгений Егор Иван Игорь Илья Кирилл Константин Лев Леонид Максим Марк Матвей
        Михаил Никита Николай Олег Павел Петр Пётр Роман Руслан Семён Сергей Станислав Степан Тимофей Тимур Фёдор Эдуард Юрий Яков Ярослав
        Димитър Стефан Тодор Олександр Андрій Сергій Дмитро Володимир Микола Петро
        """.split(),
    ("greek", "f"): """
        Αγγελική Αθηνά Αικατερίνη Αλεξάνδρα Αναστασία Άννα Αντωνία Βασιλική Γεωργία Δέσποινα Δήμητρα Ειρήνη Ελένη Ελευθερία Ευαγγελία Ζωή Ιωάννα
        Κατερίνα Κωνσταντίνα Μαρία Μαργαρίτα Παναγιώτα Παρασκευή Σοφία Σταυρούλα Χριστίνα Χρυσούλα
        """.split(),
    ("greek", "m"): """
        Αθανάσιος Αλέξανδρος Αναστάσιος Ανδρέας Αντώνης Απόστολος Βασίλης Βασίλειος Γεώργιος Γιάννης Γιώργος Δημήτρης Δημήτριος Ευάγγελος Ηλίας Θανάσης
        Θεόδωρος Ιωάννης Κωνσταντίνος Κώστας Μανώλης Μιχάλης Μιχαήλ Νικόλαος Νίκος Παναγιώτης Παύλος Πέτρος Σπύρος Σταύρος Στέφανος Χρήστος
        """.split(),
}
